from collections import Counter

import numpy as np
import pytest

from scholarweave.llm import maxent as M
from tests.llm import brute
from tests.llm.conftest import awkward, awkward_rows


def compare(rows, found):
    want = Counter((i, brute.held_out(i), *s[:3], round(s[3], 6)) for (i, _), s in zip(rows, brute.unigram_scores(rows)))
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert got == want


def test_base_on_awkward_rows(spark):
    found = M.score_documents(awkward(spark)).collect()
    compare(awkward_rows(), found)
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)


def test_held_out_texts_beat_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = M.score_documents(docs).collect()
    compare([(r.doc_id, r.text) for r in docs.collect()], found)
    out = [r for r in found if r.held_out]
    n = sum(r.n_tokens for r in out)
    assert sum(r.score for r in out) / n > sum(r.base_score for r in out) / n + 0.1


def test_counts_over_many_chunks(spark, documents, monkeypatch):
    monkeypatch.setattr(M, "CHUNK_BYTES", 3000)
    found = M.score_documents(documents.repartition(5)).collect()
    compare([(r.doc_id, r.text) for r in documents.collect()], found)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    totals = M.Totals(rng.integers(0, 900, M.CLASSES), rng.integers(0, 40, M.CLASSES))
    w = M.Weights.zero()
    w.group += rng.normal(0, 1, w.group.shape).astype(np.float32)
    w.leaf += rng.normal(0, 1, w.leaf.shape).astype(np.float32)
    before = np.repeat(rng.integers(0, M.FEATURES, (1, len(M.BUCKETS))), M.CLASSES, axis=0)
    first, second = M.class_logs(w, totals.prior(), before, np.arange(M.CLASSES, dtype=np.int32))
    each = np.arange(M.CLASSES)
    p = np.exp(first[each, each // M.GROUPS] + second[each, each % M.GROUPS].astype(np.float64))
    assert abs(p.sum() - 1) < 1e-5
    within = (totals.tokens + 0.5 * totals.distinct + 0.5) / (totals.tokens + 0.5 * (totals.distinct + 1))
    assert np.allclose(within, 1)


def test_history_stays_in_its_text():
    cls, word = np.array([3, 4, 5, 6, 7], np.int32), np.array([9, 8, 7, 6, 5], np.uint32)
    found = M.history(cls, word, np.array([3, 2]))
    none = M.CLASSES
    one, two = M.CLASSES + 1, 2 * (M.CLASSES + 1)
    assert found[:, :3].tolist() == [
        [none, one + none, two + none], [3, one + none, two + none], [4, one + 3, two + none],
        [none, one + none, two + none], [6, one + none, two + none],
    ]
    assert found.max() < M.FEATURES


def test_learning_moves_towards_the_truth():
    cls = np.tile(np.array([10, 200], np.int32), 4000)
    found = M.history(cls, cls.astype(np.uint32), np.array([len(cls)]))
    totals = M.Totals(np.full(M.CLASSES, 5), np.full(M.CLASSES, 5))
    w, touched = M.Weights.zero(), M.Weights.zero()
    for _ in range(30):
        M.learn(w, totals.prior(), found, cls, touched, 1.0)
    first, _ = M.class_logs(w, totals.prior(), found[-2:], cls[-2:])
    assert np.exp(first[0, 10 // M.GROUPS]) > 0.8 and np.exp(first[1, 200 // M.GROUPS]) > 0.8


def test_empty_table(spark):
    assert M.score_documents(awkward(spark, [])).count() == 0


@pytest.mark.parametrize("doc_id, out", [(None, False), (0, brute.held_out(0)), (-3, brute.held_out(-3))])
def test_held_out(doc_id, out):
    assert M.held_out(doc_id) is out
