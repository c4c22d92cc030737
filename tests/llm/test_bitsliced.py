import math

import numpy as np
import pytest

from scholarweave.llm import bitsliced as B

INF, NAN = math.inf, math.nan


def brute_search(rows, k=5, every=50):
    coded = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, seen = [], set()
    for i, q in coded:
        if i is None or i % every or (i, tuple(q)) in seen:
            continue
        seen.add((i, tuple(q)))
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in coded if j is not None and j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "'x' AS code", "0 AS part")
    return sorted(map(tuple, B.search(df, **how).collect()))


def vectors(n, width, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(0, spread, width).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("spread", [0.01, 0.3, 40.0])
def test_against_brute_force(spark, spread):
    rows = vectors(700, 24, 1, spread)
    assert search(spark, rows) == brute_search(rows)


def test_awkward_rows(spark):
    rows = vectors(120, 8, 2)
    rows += [(200, None), (201, [None] + [1.0] * 7), (250, [NAN] * 8), (300, [INF] * 8), (350, [0.5, -0.25]), (400, [])]
    rows += [(None, [1.0] * 8), (2**53 + 1, [1.0] * 8), (2**53, [1.0] * 8)]
    rows += [(50, rows[50][1]), (7, rows[7][1]), (7, rows[7][1]), (100, [1.0] * 8)]
    assert search(spark, rows) == brute_search(rows)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [0.5, -0.5, 0.25]) for i in range(1000, 0, -1)]
    found = search(spark, rows)
    assert found == brute_search(rows) and [r[2] for r in found[:5]] == [1, 2, 3, 4, 5]


def test_several_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 37)
    monkeypatch.setattr(B, "TILE_QUERIES", 3)
    monkeypatch.setattr(B, "TILES_TOGETHER", 2)
    rows = vectors(600, 12, 3)
    assert search(spark, rows, k=3, every=20) == brute_search(rows, 3, 20)


def test_few_candidates_and_none(spark):
    rows = vectors(3, 4, 4)
    assert search(spark, rows) == brute_search(rows) and len(search(spark, rows)) == 2
    assert search(spark, []) == [] and search(spark, [(0, [1.0])]) == []


def test_sums_are_exact():
    rng = np.random.default_rng(5)
    codes, queries = rng.integers(-300, 300, (130, 9)), rng.integers(-77, 90, (5, 9))
    slices = B.Slices(codes, planes=4)
    high = (codes - slices.low) >> slices.dropped
    want = sum(np.abs(queries[:, d])[:, None] * np.where(queries[:, d][:, None] < 0, 15 - high[:, d], high[:, d]) for d in range(9))
    bits = [np.unpackbits(s.view(np.uint8), axis=1, bitorder="little")[:, :130].astype(np.int64) for s in slices.sums(queries)]
    assert slices.dropped > 0 and (sum(b << w for w, b in enumerate(bits)) == want).all()


def test_too_large_codes():
    codes = np.full((2, 2), 1 << 40)
    with pytest.raises(OverflowError):
        B.best_of_block(B.Slices(codes), np.arange(2), codes, np.arange(2), codes, 1)
