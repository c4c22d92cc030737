"""The stages one by one against brute force, and the registered queries."""

from collections import Counter

import corpus_pipeline as C
import duckdb
import pytest

import __spark_entry__ as contract
from check_oracles import compare
from scholarweave.llm import queries as llm
from tests.llm import brute
from tests.llm.conftest import SMALL
from tests.llm.test_tokens import check_packing


def stored(spark, df, tmp_path, name):
    path = str(tmp_path / name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark, documents, tokenizer, tmp_path):
    docs, functions = documents, dict(C.STAGES)
    assert list(functions) == ["quality_rules", "near_duplicates", "secret_scan", "packing"]

    kept = stored(spark, functions["quality_rules"](spark, docs, SMALL), tmp_path, "1")
    assert kept.columns == documents.columns
    rows = {r.doc_id: r for r in kept.collect()}
    assert not any(brute.base_quality(r.text)[5] for r in rows.values())
    passed = {r.doc_id for r in documents.collect() if not brute.base_quality(r.text)[5]}
    assert set(rows) <= passed and len(rows) > 0.9 * len(passed)

    unique = stored(spark, functions["near_duplicates"](spark, kept, SMALL), tmp_path, "2")
    ids = sorted(rows)
    prints = [brute.fingerprint(rows[i].text) for i in ids]
    names = brute.linked_components(prints, ids, lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(set(names))
    assert all(r == rows[r.doc_id] for r in unique.collect())

    clean = stored(spark, functions["secret_scan"](spark, unique, SMALL), tmp_path, "3")
    assert clean.columns == documents.columns and clean.count() == unique.count()
    for r in clean.collect():
        assert r.n_chars == len(r.text) and not brute.base_spans(r.text)
        assert brute.base_spans(rows[r.doc_id].text) or r.text == rows[r.doc_id].text

    packed = functions["packing"](spark, clean, SMALL).collect()
    texts = [(r.doc_id, [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]) for r in clean.collect()]
    fills = check_packing(packed, texts)
    assert Counter(map(tuple, packed)) == Counter(map(tuple, C.run(spark, SMALL).collect()))
    assert brute.padding(fills.values()) < 0.05 * sum(fills.values())


def test_stages_of_an_empty_table(spark, documents):
    docs = documents.where("false")
    for name, stage in C.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0, name


def test_queries_are_registered():
    names = [n for n in contract.queries() if n.startswith("op") and n[2].isdigit() or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted(["pipeline", *(f"op{i}" for i in range(1, 14))])


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for table in ("conversations", "documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    ok, note = compare(spark, con, SMALL, name, forbidden=())
    assert ok, note
