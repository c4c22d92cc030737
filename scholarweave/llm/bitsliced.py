"""Exact top-k inner products by a bit-sliced index.

Vectors are turned into integer codes. The index keeps rows in blocks; within a block each
attribute is quantised to PLANES bits, and each of these bits is a bitmap over the rows: a
slice. The weighted sum of all attributes, which is the inner product with a query, is
formed for all rows of a block at once by adding slices with full adders made of bitmap
AND, OR and XOR; its result is again a set of slices. Going down from the most significant
one, the rows with the k largest sums are told apart by counting bits.

Quantising leaves out the lowest bits of each attribute, so sums are known up to a bound
that follows from the query. All rows whose sum is within the bound of the k-th are
boundary rows; they alone are scored exactly from their codes.

Each tile of queries meets each block once. Results of a block are at most k rows for a
query, and those of all blocks are ranked together.

Defined results: a row without an id, and a vector that is null or holds a null or non-finite
component, takes no part. Missing components of shorter vectors count as zero. Rows with the query's own id
are no candidates; other repeated rows are candidates once each, while repeated equal
query rows are one query. Ties go to the smaller id. If there are fewer than k candidates,
all are returned; an empty table gives an empty result. Codes so large that a score might
leave 64 bits are an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from scholarweave.llm import texts
from scholarweave.workspace import materialise

PLANES = 6
BLOCK_ROWS = 4096
TILE_QUERIES = 64
TILES_TOGETHER = 16

_ROW = "part long, n long, width long, ids binary, codes binary, kind string"


def coded_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, code array<bigint>) of the vectors that take part."""
    texts.with_workers(df.sparkSession)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    chosen = df.select(F.col(f"`{key}`").cast("bigint").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    return chosen.na.drop().where(F.forall("v", finite)).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("code")
    )


def _tables(coded: DataFrame, rows: int) -> DataFrame:
    """Coded vectors, up to ``rows`` of them in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                lists = part.column("code")
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                width = int(sizes.max())
                codes = np.zeros((len(sizes), width), np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(owner)) - texts.starts_of(sizes)[:-1][owner]
                codes[owner, place] = lists.flatten().to_numpy(zero_copy_only=False)
                most = int(np.abs(codes).max(initial=0))
                kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
                ids = part.column("vec_id").to_numpy(zero_copy_only=False).astype("<i8")
                yield pa.RecordBatch.from_pylist(
                    [{
                        "part": number, "n": len(sizes), "width": width, "ids": ids.tobytes(),
                        "codes": codes.astype(kind).tobytes(), "kind": kind,
                    }]
                )
                number += 1

    return coded.mapInArrow(run, _ROW)


def _codes(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["codes"], row["kind"]).reshape(row["n"], row["width"]).astype(np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    short = -bits.shape[-1] % 64
    padded = np.pad(bits, [(0, 0)] * (bits.ndim - 1) + [(0, short)])
    return np.ascontiguousarray(np.packbits(padded, axis=-1, bitorder="little")).view("<u8")


class Slices:
    """The bit slices of one block of codes."""

    def __init__(self, codes: np.ndarray, planes: int = PLANES) -> None:
        self.rows, self.planes = len(codes), planes
        self.low = codes.min(axis=0, initial=2**62) if len(codes) else codes.sum(axis=0)
        spread = int((codes - self.low).max(initial=0))
        self.dropped = max(0, spread.bit_length() - planes)
        high = ((codes - self.low) >> self.dropped).T
        self.maps = [_packed((high >> b) & 1 > 0) for b in range(planes)]  # [bit][attribute, word]

    def sums(self, queries: np.ndarray) -> list[np.ndarray]:
        """Slices, lowest first, of the sums of |q| * u, where u is an attribute's quantised
        value or, if q is negative, its complement. Each slice is [query, word]."""
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        flip = np.where(queries < 0, full, np.uint64(0)).T[:, :, None]
        size = np.abs(queries)
        bits = int(size.max(initial=0)).bit_length()
        has = [np.where((size >> j) & 1 > 0, full, np.uint64(0)).T[:, :, None] for j in range(bits)]
        done: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        shape = (len(queries), self.maps[0].shape[-1])
        for weight in range(bits + self.planes + 64):
            pending, carried = carried, []
            total: np.ndarray | None = None
            second: np.ndarray | None = None
            for plane in self._planes(weight, pending, flip, has):
                if total is None:
                    total = plane
                elif second is None:
                    second = plane
                else:  # a full adder
                    half = total ^ second
                    carry = total & second
                    total = half ^ plane
                    np.bitwise_and(half, plane, out=half)
                    np.bitwise_or(carry, half, out=carry)
                    carried.append(carry)
                    second = None
            if second is not None:
                carried.append(total & second)
                total = total ^ second
            if total is None and weight >= bits + self.planes - 1:
                break
            done.append(np.zeros(shape, np.uint64) if total is None else total)
        return done

    def _planes(self, weight: int, pending: list[np.ndarray], flip: np.ndarray, has: list[np.ndarray]):
        while pending:
            yield pending.pop()
        for b in range(max(0, weight - len(has) + 1), min(self.planes, weight + 1)):
            for attribute, row in enumerate(self.maps[b]):
                plane = row[None, :] ^ flip[attribute]
                plane &= has[weight - b][attribute]
                yield plane

    def boundary(self, queries: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
        """[query, row]: the rows that may be among the ``k`` best of the allowed ones."""
        sums = self.sums(queries)
        rest, need = _packed(allowed), np.full(len(queries), k)
        kth = [0] * len(queries)
        for weight in range(len(sums) - 1, -1, -1):
            ones = rest & sums[weight]
            count = np.bitwise_count(ones).sum(axis=1, dtype=np.int64)
            enough = count >= need
            rest = np.where(enough[:, None], ones, rest & ~sums[weight])
            need = np.where(enough, need, need - count)
            kth = [v | (1 << weight) if e else v for v, e in zip(kth, enough.tolist())]
        # What quantising left out of each sum is at most this many units of a sum.
        slack = np.abs(queries).sum(axis=1) * ((1 << self.dropped) - 1) >> self.dropped
        least = [max(0, v - int(s) - 1) if self.dropped else v for v, s in zip(kth, slack)]
        equal, above = _packed(allowed), np.zeros_like(rest)
        for weight in range(len(sums) - 1, -1, -1):
            wanted = np.array([(v >> weight) & 1 for v in least], bool)[:, None]
            above |= np.where(wanted, np.uint64(0), equal & sums[weight])
            equal &= np.where(wanted, sums[weight], ~sums[weight])
        bits = np.unpackbits((above | equal).view(np.uint8), axis=1, bitorder="little")
        return bits[:, : self.rows].astype(bool)


def best_of_block(
    slices: Slices, ids: np.ndarray, codes: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, row, score) of the ``k`` best rows of a block for each query."""
    if int(np.abs(codes).max(initial=0)) * int(np.abs(queries).sum(axis=1).max(initial=0)) >= 1 << 62:
        raise OverflowError("scores of these vectors do not fit 64 bits")
    q, row = np.nonzero(slices.boundary(queries, query_ids[:, None] != ids[None, :], k))
    score = np.zeros(len(q), np.int64)
    for at in range(0, len(q), 1 << 15):
        some = slice(at, at + (1 << 15))
        score[some] = np.einsum("ij,ij->i", queries[q[some]], codes[row[some]])
    order = np.lexsort((ids[row], -score, q))
    q, row, score = q[order], row[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], row[place < k], score[place < k]


def search(
    df: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row whose id ``every`` divides."""
    coded = coded_vectors(df, key, vector, scale)
    blocks = materialise(_tables(coded, BLOCK_ROWS), "blocks")
    asked = coded.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "code"])
    tiles = materialise(_tables(asked, TILE_QUERIES), "tiles")
    # Blocks and tiles meet in a grid of cells; a cell holds a few blocks and some tiles.
    across, down = max(1, blocks.count()), max(1, math.ceil(tiles.count() / TILES_TOGETHER))

    def spread(table: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return table.withColumn(own, F.pmod(F.xxhash64("part"), F.lit(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    names = ["_block", "_tile", *[c.split(" ")[0] for c in _ROW.split(", ")]]
    grid = spread(blocks, "_block", across, "_tile", down).select(*names, F.lit(True).alias("_is_block")).unionByName(
        spread(tiles, "_tile", down, "_block", across).select(*names, F.lit(False).alias("_is_block"))
    )

    def cell(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for block in (r for r in rows if r["_is_block"]):
            ids, codes = _codes(block)
            slices = Slices(codes)
            for tile in (r for r in rows if not r["_is_block"]):
                query_ids, queries = _codes(tile)
                width = max(codes.shape[1], queries.shape[1])
                if queries.shape[1] < width:
                    queries = np.pad(queries, [(0, 0), (0, width - queries.shape[1])])
                q, row, score = best_of_block(slices, ids, codes, query_ids, queries[:, : codes.shape[1]], k)
                for column, values in zip(out, (query_ids[q], np.full(len(q), tile["part"]), q, ids[row], score)):
                    column.append(values)
        none = [np.zeros(0, np.int64)]
        return pa.table(dict(zip(("query_id", "_part", "_place", "vec_id", "score"), (pa.array(np.concatenate(none + c).astype(np.int64)) for c in out))))

    found = grid.groupBy("_block", "_tile").applyInArrow(
        cell, "query_id long, _part long, _place long, vec_id long, score long"
    )
    best = Window.partitionBy("_part", "_place").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
