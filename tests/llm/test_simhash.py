import random
from collections import Counter

import numpy as np

from scholarweave.llm import simhash as S
from tests.llm import brute
from tests.llm.conftest import awkward, awkward_rows

near = lambda a, b: (a ^ b).bit_count() <= 2


def expected(rows):
    prints = [brute.fingerprint(t) for _, t in rows]
    names = brute.linked_components(prints, [i for i, _ in rows], near)
    return Counter((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, prints, names))


def test_awkward_rows(spark):
    assert Counter(map(tuple, S.near_duplicates(awkward(spark)).collect())) == expected(awkward_rows())


def test_the_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert Counter(map(tuple, S.near_duplicates(documents).collect())) == expected(rows)


def test_shingles_in_parts(monkeypatch):
    text = " ".join(f"W{i % 89}" for i in range(1000))
    monkeypatch.setattr(S, "SHINGLES_AT_ONCE", 7)
    assert S.fingerprint(text) == brute.fingerprint(text)


def crowd(n: int, seed: int) -> list[int]:
    """Fingerprints in balls around a few centres, many of them linked."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)] + [0, (1 << 64) - 1]
    loose = [rng.sample(range(64), 9) for _ in centres]
    out = set()
    for _ in range(n):
        k = rng.randrange(len(centres))
        flips = sum(1 << b for b in loose[k] if rng.random() < 0.25)
        out.add(centres[k] ^ flips)
    return sorted(out)


def found_components(spark, values, monkeypatch, crowd_size):
    monkeypatch.setattr(S, "CROWD", crowd_size)
    signed = [S._signed(v) for v in values]
    stored = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long").repartition(3)
    return {r.doc_id: r.component_id for r in S.label(stored).collect()}


def test_crowds_lose_no_link(spark, monkeypatch):
    values = crowd(900, 5)
    want = dict(enumerate(brute.linked_components(values, list(range(len(values))), near)))
    assert len(set(want.values())) > 3
    for size in (2, 40, 1024):  # nearly all places are crowds, some, none
        assert found_components(spark, values, monkeypatch, size) == want


def test_chain_is_one_component(spark, monkeypatch):
    values = [(1 << n) - 1 for n in range(0, 64, 2)]  # each two bits from the next
    assert set(found_components(spark, values, monkeypatch, 1024).values()) == {0}


def test_pivots_never_discard_a_link():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    bits = rng.integers(0, 64, (200, 2)).astype(np.uint64)
    other = fp ^ (np.uint64(1) << bits[:, 0]) ^ (np.uint64(1) << bits[:, 1])
    both = np.stack([fp, other], axis=1).reshape(-1)
    left, right = S.linked_pairs(both, np.repeat(np.arange(200), 2))
    assert (left == np.arange(0, 400, 2)).all() and (right == left + 1).all()
    assert len(S.REFERENCES) == len(set(S.REFERENCES.tolist())) == 64


def test_keep_one_each(spark):
    docs = awkward(spark)
    kept = S.keep_one_each(docs)
    assert kept.schema == docs.schema
    rows = kept.collect()
    groups = {(r.component_id) for r in S.near_duplicates(docs).collect()}
    assert len(rows) == len(groups) and sum(r.doc_id == 7 for r in rows) == 0
    assert {r.doc_id for r in rows} == groups


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(5, "some text of five words")] * 4 + [(None, None)] * 3, "doc_id long, text string")
    assert Counter(r.doc_id for r in S.keep_one_each(docs).collect()) == {5: 1, None: 1}


def test_empty_table(spark):
    assert S.near_duplicates(awkward(spark, [])).count() == 0 and S.keep_one_each(awkward(spark, [])).count() == 0
