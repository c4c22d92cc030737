"""Hard negatives by exact inner products, scored with the method of the Four Russians.

Vectors are turned into integer codes. Candidates are kept in blocks; within a block the
codes, less the smallest code of each dimension, are cut into bit planes, and the bits of
eight dimensions in one plane make one byte. For each anchor and each group of eight
dimensions a table holds the sums of all 256 subsets of the anchor's eight codes. An inner
product is then one table lookup for each byte, the lookups of a plane added, the planes
shifted and added from the highest down; the sum is the exact score.

Anchors, in tiles, meet blocks in a grid of cells. A first round keeps in each cell the best
rows of the anchor's own label and ranks those of all cells: the positives. A second round
goes over the grid again with the window of scores that follows from each positive and keeps
the best rows of other labels inside it. The k-th score that a cell has found so far is the
least that its later blocks have to reach. A cell returns at most k rows for what it was
asked, so the ranking of all cells is a window over few rows for each anchor and positive.

Defined results: a row takes no part if its id, label or vector is null or its vector holds
a null or non-finite component. Missing components of shorter vectors count as zero. Rows
with the anchor's own id are neither its positives nor its negatives; other repeated rows
count once each, while equal rows that are anchors are one anchor. Equal scores go by the
smaller id. Fewer rows than asked for are returned whole, and an anchor without positives or
a positive without negatives gives no rows. An empty table gives an empty result. Scores
that may leave 59 bits are an error.
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

BLOCK_ROWS = 4096
BLOCKS_TOGETHER = 16
TILE_ANCHORS = 64
TILES_TOGETHER = 16
CHUNK_ROWS = 1024
GROUP = 8
LARGEST = 1 << 59

_BLOCK = "part long, n long, width long, planes long, low binary, bytes binary, ids binary, labels binary"
_TILE = "part long, n long, width long, codes binary, numbers binary, ids binary, labels binary, marks binary, each long"


def coded_vectors(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(vec_id, label, code array<bigint>) of the rows that take part."""
    texts.with_workers(df.sparkSession)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    chosen = df.select(
        F.col(f"`{key}`").cast("bigint").alias("vec_id"), F.col(f"`{label}`").cast("bigint").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("v"),
    ).na.drop()
    return chosen.where(F.forall("v", finite)).select("vec_id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("code"))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Lists as rows of one width, a multiple of eight, filled up with zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.zeros((len(sizes), -(-int(sizes.max(initial=0)) // GROUP) * GROUP), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    codes[owner, np.arange(len(owner)) - texts.starts_of(sizes)[:-1][owner]] = lists.flatten().to_numpy(zero_copy_only=False)
    return codes


def _longs(batch: pa.RecordBatch, name: str) -> bytes:
    return batch.column(name).to_numpy(zero_copy_only=False).astype("<i8").tobytes()


def cut_planes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, bytes): the smallest code of each dimension, and [plane, group, row] of what is above it."""
    low = codes.min(axis=0)
    above = codes - low
    planes = int(above.max(initial=0)).bit_length()
    packed = [np.packbits((above >> b & 1).astype(bool), axis=1, bitorder="little").T for b in range(planes)]
    shape = (planes, codes.shape[1] // GROUP, len(codes))
    return low, np.ascontiguousarray(np.array(packed, np.uint8).reshape(shape))


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """[group, subset, anchor]: sums of each subset of eight codes of each anchor."""
    groups = anchors.shape[1] // GROUP
    sums = np.zeros((groups, 1 << GROUP, len(anchors)), kind)
    by_group = anchors.T.reshape(groups, GROUP, len(anchors))
    for i in range(GROUP):
        sums[:, 1 << i : 2 << i] = sums[:, : 1 << i] + by_group[:, i, None]
    return sums


def scores(low: np.ndarray, packed: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """[anchor, row]: exact inner products of the rows of a block with some anchors."""
    planes, groups, rows = packed.shape
    most = max(float(np.abs(low.astype(float)).max(initial=0)), 0.0) + 2.0**planes
    bound = float(np.abs(anchors.astype(float)).sum(axis=1).max(initial=0)) * most
    if bound >= LARGEST:
        raise OverflowError("scores of these vectors do not fit 59 bits")
    kind = np.int32 if bound < 1 << 30 else np.int64
    sums = subset_sums(anchors, kind)
    out = np.empty((len(anchors), rows), np.int64)
    for at in range(0, rows, CHUNK_ROWS):
        chunk = packed[:, :, at : at + CHUNK_ROWS]
        total = np.zeros((chunk.shape[2], len(anchors)), kind)
        found = np.empty_like(total)
        for plane in chunk[::-1]:
            total <<= 1
            for group, table in zip(plane, sums):
                total += np.take(table, group, axis=0, out=found, mode="clip")
        out[:, at : at + CHUNK_ROWS] = total.T
    return out + (anchors @ low)[:, None]


def best_rows(
    score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(line, row) of the ``k`` best allowed rows of each line, those below ``least`` left out."""
    hit = allowed & (score >= least[:, None])
    many = np.flatnonzero(hit.sum(axis=1) > 4 * k)
    if len(many):
        some = np.where(hit[many], score[many], np.iinfo(np.int64).min)
        kth = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k]
        hit[many] &= score[many] >= kth[:, None]
    line, row = np.nonzero(hit)
    order = np.lexsort((ids[row], -score[line, row], line))
    line, row = line[order], row[order]
    first = np.arange(len(line)) - np.searchsorted(line, line) < k
    return line[first], row[first]


def block_table(coded: DataFrame) -> DataFrame:
    """Blocks of candidates, one in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                codes = _matrix(part.column("code"))
                if float(np.abs(codes.astype(float)).max(initial=0)) >= LARGEST:
                    raise OverflowError("scores of these vectors do not fit 59 bits")
                low, packed = cut_planes(codes)
                yield pa.RecordBatch.from_pylist(
                    [{
                        "part": number, "n": part.num_rows, "width": codes.shape[1], "planes": len(packed),
                        "low": low.astype("<i8").tobytes(), "bytes": packed.tobytes(),
                        "ids": _longs(part, "vec_id"), "labels": _longs(part, "label"),
                    }]
                )
                number += 1

    return coded.mapInArrow(run, _BLOCK)


def tile_table(anchors: DataFrame) -> DataFrame:
    """Tiles of anchors (number, vec_id, label, code, marks), one in a row.

    ``marks`` are the scores of an anchor's positives; all anchors of a tile have room for
    as many, those that are missing are null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ANCHORS):
                part = batch.slice(at, TILE_ANCHORS)
                codes = _matrix(part.column("code"))
                marks = [m or [] for m in part.column("marks").to_pylist()]
                each = max(map(len, marks))
                # No score is as small, so what is missing has an empty window.
                filled = np.array([m + [-LARGEST] * (each - len(m)) for m in marks], "<i8")
                yield pa.RecordBatch.from_pylist(
                    [{
                        "part": number, "n": part.num_rows, "width": codes.shape[1], "codes": codes.astype("<i8").tobytes(),
                        "numbers": _longs(part, "number"), "ids": _longs(part, "vec_id"), "labels": _longs(part, "label"),
                        "marks": filled.tobytes(), "each": each,
                    }]
                )
                number += 1

    return anchors.mapInArrow(run, _TILE)


def _array(row: dict, name: str, *shape: int) -> np.ndarray:
    return np.frombuffer(row[name], "<i8").reshape(shape or (-1,))


class Block:
    """A stored block as arrays."""

    def __init__(self, row: dict) -> None:
        self.ids, self.labels, self.low = (_array(row, c) for c in ("ids", "labels", "low"))
        self.width = row["width"]
        self.packed = np.frombuffer(row["bytes"], np.uint8).reshape(row["planes"], self.width // GROUP, row["n"])

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        # Dimensions that only one side has add nothing.
        short = self.width - anchors.shape[1]
        anchors = np.pad(anchors, [(0, 0), (0, short)]) if short > 0 else anchors[:, : self.width]
        return scores(self.low, self.packed, anchors)


class Tile:
    """A stored tile of anchors, and the best rows found for it so far."""

    def __init__(self, row: dict, k: int, low: int, high: int) -> None:
        self.k = k
        self.numbers, self.ids, self.labels = (_array(row, c) for c in ("numbers", "ids", "labels"))
        self.codes = _array(row, "codes", row["n"], row["width"])
        marks = _array(row, "marks", row["n"], row["each"])
        # One line of windows for each place of a positive; none in the first round.
        self.windows = [(-(-low * m // 100), high * m // 100) for m in marks.T]
        lines = max(1, len(self.windows))
        self.best = [(np.zeros(0, np.int64),) * 3 for _ in range(lines)]
        self.least = [np.full(row["n"], -LARGEST - 1) for _ in range(lines)]

    def add(self, block: Block) -> None:
        score = block.scores(self.codes)
        other = self.ids[:, None] != block.ids[None, :]
        same = self.labels[:, None] == block.labels[None, :]
        if not self.windows:
            self._keep(0, score, other & same, block.ids)
        for line, (low, high) in enumerate(self.windows):
            self._keep(line, score, other & ~same & (score >= low[:, None]) & (score <= high[:, None]), block.ids)

    def _keep(self, line: int, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        who, row = best_rows(score, allowed, ids, self.k, self.least[line])
        if not len(who):
            return
        old = self.best[line]
        who, found, value = (np.concatenate(pair) for pair in zip(old, (who, ids[row], score[who, row])))
        order = np.lexsort((found, -value, who))
        who, found, value = who[order], found[order], value[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        kth = place == self.k - 1
        self.least[line][who[kth]] = value[kth]
        self.best[line] = (who[place < self.k], found[place < self.k], value[place < self.k])

    def result(self) -> list[np.ndarray]:
        """number, line, id and score of the rows found."""
        lines = np.repeat(np.arange(len(self.best)), [len(b[0]) for b in self.best])
        who, found, value = (np.concatenate(c) for c in zip(*self.best))
        return [self.numbers[who], lines, found, value]


def _met(blocks: DataFrame, tiles: DataFrame, k: int, low: int = 0, high: int = 0) -> DataFrame:
    """(number, line, vec_id, score, rank): the ``k`` best rows for each anchor and line."""
    n_blocks, n_tiles = max(1, blocks.count()), max(1, tiles.count())
    # A cell holds some blocks and some tiles. Small tables are cut finer, to use all cores.
    across = -(-n_blocks // BLOCKS_TOGETHER)
    spare = 2 * blocks.sparkSession.sparkContext.defaultParallelism // across
    down = max(-(-n_tiles // TILES_TOGETHER), min(n_tiles, spare))

    def spread(table: DataFrame, own: str, n_own: int, other: str, n_other: int, kind: str) -> DataFrame:
        body = F.struct(*table.columns)
        return table.select(
            F.pmod(F.xxhash64("part"), F.lit(n_own)).alias(own), F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
            *[(body if kind == c else F.lit(None)).alias(c) for c in ("block", "tile")],
        ).select((F.col("_across") * down + F.col("_down")).alias("_cell"), "block", "tile")

    grid = spread(blocks, "_across", across, "_down", down, "block").unionByName(
        spread(tiles, "_down", down, "_across", across, "tile")
    )

    def cell(group: pa.Table) -> pa.Table:
        kept = [Tile(row, k, low, high) for row in group.column("tile").drop_null().to_pylist()]
        for chunk in group.column("block").drop_null().chunks:
            for row in chunk:
                block = Block(row.as_py())
                for tile in kept:
                    tile.add(block)
        columns = [np.concatenate(c) for c in zip(*(t.result() for t in kept))] or [np.zeros(0, np.int64)] * 4
        return pa.table(dict(zip(("number", "line", "vec_id", "score"), (pa.array(c, pa.int64()) for c in columns))))

    found = grid.repartition(across * down, "_cell").groupBy("_cell").applyInArrow(
        cell, "number long, line long, vec_id long, score long"
    )
    best = Window.partitionBy("number", "line").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(
    df: DataFrame, positives: int = 5, negatives: int = 10, every: int = 100, low: int = 30, high: int = 90,
    key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``every`` divides. A negative's score lies between ``low``
    and ``high`` hundredths of the positive's, both included.
    """
    coded = coded_vectors(df, key, vector, label, scale)
    blocks = materialise(block_table(coded), "blocks")
    asked = coded.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "label", "code"])
    anchors = materialise(asked.withColumn("number", F.monotonically_increasing_id()), "anchors")

    plain = anchors.withColumn("marks", F.array().cast("array<bigint>"))
    first = materialise(_met(blocks, materialise(tile_table(plain), "tiles"), positives), "positives")
    ranked = F.array_sort(F.collect_list(F.struct("rank", "score")))
    marks = first.groupBy("number").agg(F.transform(ranked, lambda p: p["score"]).alias("marks"))
    second = _met(blocks, materialise(tile_table(anchors.join(marks, "number")), "tiles"), negatives, low, high)

    of_positive = first.select(
        "number", (F.col("rank") - 1).cast("bigint").alias("line"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        second.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        .join(of_positive, ["number", "line"])
        .join(anchors.select("number", F.col("vec_id").alias("anchor_id")), "number")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
