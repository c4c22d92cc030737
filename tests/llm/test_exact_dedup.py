import hashlib
import re

import pytest

from scholarweave.llm import exact_dedup as X, queries
from tests.llm.conftest import SMALL, awkward, awkward_rows

INF = float("inf")


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), INF if i is None else i, i))
    out = []
    for body, members in groups.items():
        digest = hashlib.sha256(body.encode()).hexdigest()
        for n, member in enumerate(sorted(members)):
            out.append((member[2], min(members)[2], len(members), n == 0, digest))
    return sorted(out, key=repr)


def found(df):
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in X.find_copies(df, digest=True).select(*names).collect()), key=repr)


def test_whole_query_against_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    result = queries.QUERIES["op13_exact_dedup"](spark, SMALL)
    assert sorted((tuple(r) for r in result.select(*names).collect()), key=repr) == brute(rows)


def test_awkward_rows(spark):
    rows = awkward_rows() + [
        (20, "a b c"), (21, "abc "), (22, "\ta\nbc\x0b\x0c\r  "), (23, "abc "), (24, "ab"), (25, "abd"), (26, " a b\tc"),
        (27, "İ x"), (28, "İx"), (29, "abc\x1c"), (29, "abc\x1c"), (None, "abc"),
    ]
    assert found(awkward(spark, rows)) == brute(rows)


def test_a_third_of_all_rows_equal(spark):
    rows = [(i, "same  text" if i % 3 == 0 else f"text {i}") for i in range(600)]
    rows += [(i, "other") for i in range(1000, 1100)]
    result = found(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert result == brute(rows)


def test_equal_beginnings_and_lengths(spark, monkeypatch):
    start = "x" * 5000
    rows = [(i, start + f"{i // 2:05d}") for i in range(200)] + [(500, start + "00000 "), (501, "y" * 5005)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows)
    # A full bitmap lets every row through; the groups are the same.
    monkeypatch.setattr("scholarweave.llm.spread.MOST_BITS", 1 << 15)
    monkeypatch.setattr("scholarweave.llm.spread.KeyFilter.may_have", lambda self, hashed: hashed == hashed)
    assert found(df) == brute(rows)


def test_whole_text_is_hashed_for_survivors_only(spark):
    rows = [(i, f"{i} " * 50) for i in range(100)] + [(200, "7 " * 50)]
    read = X._read(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", None)
    survivors = X.surviving(X.signatures(read))
    hashed = {r.doc_id for r in X._hashed(read, survivors, False).collect() if r.full is not None}
    assert {7, 200} <= hashed and len(hashed) < 20


def test_kept_rows_have_all_columns(spark):
    rows = awkward_rows() * 2
    df = awkward(spark, rows)
    kept = X.keep_one_each(df)
    assert kept.columns == df.columns
    assert kept.count() == sum(r[3] for r in brute(rows))


@pytest.mark.parametrize("digest", [True, False])
def test_empty_table(spark, digest):
    assert X.find_copies(awkward(spark, []), digest=digest).collect() == []


def test_filter_has_no_false_negatives(spark):
    from scholarweave.llm.spread import KeyFilter

    keys = spark.range(5000).selectExpr("xxhash64(id) AS h")
    kept = KeyFilter(keys, "h")
    import numpy as np

    inside = np.array([r.h for r in keys.collect()])
    outside = np.array([r.h for r in spark.range(10_000, 30_000).selectExpr("xxhash64(id) AS h").collect()])
    assert kept.may_have(inside).all() and kept.may_have(outside).mean() < 0.05
