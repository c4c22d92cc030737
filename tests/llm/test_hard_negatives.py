import math

import numpy as np
import pytest

from scholarweave.llm import hard_negatives as H
from tests.llm.test_bitsliced import vectors

INF, NAN = math.inf, math.nan


def brute_mine(rows, positives=5, negatives=10, every=100, low=30, high=90):
    coded = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, seen = [], set()
    for i, label, a in coded:
        if i % every or (i, label, tuple(a)) in seen:
            continue
        seen.add((i, label, tuple(a)))
        scored = sorted((-sum(x * y for x, y in zip(a, v)), j, own == label) for j, own, v in coded if j != i)
        best = [(-s, j) for s, j, same in scored if same][:positives]
        for p, positive in best:
            fit = [(-s, j) for s, j, same in scored if not same and low * p <= -100 * s <= high * p]
            out += [(i, positive, n + 1, j, p, s) for n, (s, j) in enumerate(fit[:negatives])]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.selectExpr("*", "1 AS score", "'x' AS code", "0 AS part", "2 AS number", "3 AS marks", "'r' AS rank")
    return sorted(map(tuple, H.mine(df, **how).collect()))


def labelled(n, width, seed, spread=0.3, labels=4):
    rng = np.random.default_rng(seed)
    return [(i, v, int(label)) for (i, v), label in zip(vectors(n, width, seed, spread), rng.integers(0, labels, n))]


@pytest.mark.parametrize("spread, width", [(0.01, 24), (0.3, 21), (40.0, 8)])
def test_against_brute_force(spark, spread, width):
    rows = labelled(700, width, 1, spread)
    found = mined(spark, rows)
    assert found == brute_mine(rows) and (spread < 0.1 or len(found) > 100)


def test_awkward_rows(spark):
    rows = labelled(150, 8, 2)
    rows += [(200, None, 1), (201, [None] + [1.0] * 7, 1), (300, [NAN] * 8, 1), (400, [INF] * 8, 1), (500, [0.5, -0.25], 2)]
    rows += [(600, [], 0), (700, [1.0] * 8, None), (None, [1.0] * 8, 1), (800, [1.0] * 12, 1), (801, [1.0] * 12, 1)]
    rows += [(100, rows[100][1], rows[100][2]), (7, rows[7][1], rows[7][2]), (7, rows[7][1], rows[7][2]), (0, [1.0] * 8, 3)]
    rows += [(-100, [0.5] * 8, 2), (2**53 + 1, [0.5] * 8, 2), (2**53, [0.5] * 8, 1)]
    assert mined(spark, rows) == brute_mine(rows)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [0.5, -0.5, 0.25], i % 2) for i in range(600, 0, -1)] + [(2000 + i, [0.2, -0.2, 0.1], i % 3) for i in range(90)]
    found = mined(spark, rows)
    assert found == brute_mine(rows) and len(found) > 100


def test_several_blocks_and_tiles(spark, monkeypatch):
    for name, size in [("BLOCK_ROWS", 37), ("TILE_ANCHORS", 3), ("TILES_TOGETHER", 2), ("BLOCKS_TOGETHER", 3), ("CHUNK_ROWS", 10)]:
        monkeypatch.setattr(H, name, size)
    rows = labelled(600, 12, 3)
    how = dict(positives=3, negatives=4, every=20, low=10, high=95)
    assert mined(spark, rows, **how) == brute_mine(rows, **how)


def test_one_label_no_negatives_and_empty(spark):
    rows = [(i, [1.0, 0.5], 1) for i in range(300)]
    assert mined(spark, rows) == [] and mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []


def test_scores_are_exact():
    rng = np.random.default_rng(5)
    for spread in (1, 300, 1 << 20):
        codes, anchors = rng.integers(-spread, spread + 1, (130, 24)), rng.integers(-spread, spread + 1, (5, 24))
        assert (H.scores(*H.cut_planes(codes), anchors) == anchors @ codes.T).all()
    tables = H.subset_sums(anchors[:, :8], np.int64)
    assert tables.shape == (1, 256, 5) and (tables[0, 0b10000101] == anchors[:, [0, 2, 7]].sum(axis=1)).all()


def test_too_large_codes():
    codes = np.full((2, 8), 1 << 40)
    with pytest.raises(OverflowError):
        H.scores(*H.cut_planes(codes), codes)
