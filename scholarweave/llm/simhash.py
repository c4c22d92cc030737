"""SimHash near-duplicates found by tables of distances to reference fingerprints.

A text's fingerprint has a bit set if more than half of its shingle hashes have it set.
Two fingerprints link if at most MAX_BITS of their 64 bits differ; linked texts and the
texts linked to those form a component.

Pivots. For every distinct fingerprint the Hamming distances to many reference
fingerprints are computed. By the triangle inequality no coordinate of two linked
fingerprints differs by more than MAX_BITS, so one larger difference discards a pair
without comparing the fingerprints. Survivors are verified bit by bit.

Meeting. References that differ from the zero fingerprint in one of BLOCKS blocks only
tell, by the difference to the distance from zero, about this block alone. Linked
fingerprints agree in all but MAX_BITS blocks, so they have the same coordinates for the
references of at least BLOCKS - MAX_BITS blocks: each fingerprint is dealt out once for
each choice of such blocks, by a hash of those coordinates, and pairs are formed only of
fingerprints that meet there. Copies are one fingerprint and never meet each other.

Crowds. More than CROWD fingerprints at one place are not compared there: they are dealt
out again for each choice of MAX_BITS of the remaining nibbles, which alone may differ.
At most 256 fingerprints can then meet, so the work stays linear in any crowd, and no
link is lost. Of the links found at one place only a spanning forest is kept.

Defined results: a null text is empty; without words the fingerprint is zero and links
like any other. Rows with the same doc_id are separate texts. A null doc_id gives way to
any other as a component's name. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from scholarweave.llm import texts
from scholarweave.workspace import materialise

MAX_BITS = 2
BLOCKS = 4
CROWD = 1024
PER_BLOCK = 12
OVERALL = 15
SHINGLES_AT_ONCE = 1 << 18
_BITS = 64 // BLOCKS
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def _references() -> tuple[list[list[int]], list[int]]:
    """References inside each block, and references over all bits, as unsigned numbers.

    They are hashes of their own numbers, so every task has the same ones.
    """
    word = lambda name: xxhash.xxh64_intdigest(name, 0)
    block = lambda b: ((1 << _BITS) - 1) << (b * _BITS)
    inside = [[word(f"block {b} {i}") & block(b) for i in range(PER_BLOCK)] for b in range(BLOCKS)]
    return inside, [0, *(word(f"overall {i}") for i in range(OVERALL))]


IN_BLOCKS, OVER_ALL = _references()
REFERENCES = np.array(OVER_ALL + [r for refs in IN_BLOCKS for r in refs], np.uint64)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str, size: int = 3, seed: int = 42) -> int:
    """Fingerprint of one text as an unsigned number."""
    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return 0
    starts = max(1, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, starts, SHINGLES_AT_ONCE):
        part = words[at : min(at + SHINGLES_AT_ONCE, starts) + size - 1]
        if len(part) < size:
            shingles = [" ".join(part)]
        else:
            shingles = map(" ".join, zip(*(part[i:] for i in range(size))))
        hashes = np.fromiter((digest(s, seed) for s in shingles), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > starts, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """(doc_id, fp) with fp as a signed long; also ``row``, if that column is named."""
    docs = texts.id_and_text(df, key, text)
    names = ["doc_id"]
    if row is not None:
        docs, names = df.select(F.col(f"`{row}`").alias("_row"), *_renamed(key, text)), ["doc_id", "_row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows)
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], [*names, "fp"])

    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "fp"]))


def _renamed(key: str, text: str) -> list[Column]:
    return [F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")]


def _block_coordinates(fp: Column, block: int) -> list[Column]:
    """Distances to a block's references less the distance to zero."""
    to_zero = F.bit_count(fp)
    return [F.bit_count(fp.bitwiseXOR(F.lit(_signed(r)))) - to_zero for r in IN_BLOCKS[block]]


def meeting_places(distinct: DataFrame) -> DataFrame:
    """(place, free, fp): one row for each choice of blocks that may differ."""
    fp = F.col("fp")
    signs = distinct.select(
        "fp", *[F.xxhash64(*_block_coordinates(fp, b)).alias(f"_b{b}") for b in range(BLOCKS)]
    )
    choices = [
        F.struct(
            F.xxhash64(F.lit(n), *[f"_b{b}" for b in range(BLOCKS) if b not in free]).alias("place"),
            F.lit(n).alias("free"),
        )
        for n, free in enumerate(combinations(range(BLOCKS), MAX_BITS))
    ]
    return signs.select("fp", F.explode(F.array(*choices)).alias("p")).select("p.place", "p.free", "fp")


def _finer_places(crowded: DataFrame) -> DataFrame:
    """The same, with MAX_BITS of the nibbles of the free blocks that may differ."""
    by_choice = []
    for free in combinations(range(BLOCKS), MAX_BITS):
        nibbles = [0xF << (b * _BITS + 4 * i) for b in free for i in range(_BITS // 4)]
        masks = [reduce(int.__or__, pair) for pair in combinations(nibbles, MAX_BITS)]
        by_choice.append(F.array(*[F.lit(_signed(~m & (1 << 64) - 1)) for m in masks]))
    masks = F.get(F.array(*by_choice), F.col("free"))
    dealt = crowded.select("place", "free", "fp", F.explode(masks).alias("_mask"))
    return dealt.select(
        F.xxhash64("place", "_mask", F.col("fp").bitwiseAND(F.col("_mask"))).alias("place"), "free", "fp"
    )


def linked_pairs(fp: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of linked fingerprints at the same place; ``place`` is sorted."""
    table = np.bitwise_count(fp[:, None] ^ REFERENCES[None, :]).view(np.int8)
    left, right = [], []
    for lag in range(1, len(fp)):
        i = np.flatnonzero(place[lag:] == place[:-lag])
        if not len(i):
            break
        for some in np.array_split(i, 1 + len(i) // 65536):
            near = np.abs(table[some] - table[some + lag]).max(axis=1) <= MAX_BITS
            some = some[near]
            some = some[np.bitwise_count(fp[some] ^ fp[some + lag]) <= MAX_BITS]
            left.append(some)
            right.append(some + lag)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(none + left), np.concatenate(none + right)


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each index the least one that it is connected to."""
    least = np.arange(n)
    while True:
        both = np.minimum(least[left], least[right])
        if (least[left] == both).all() and (least[right] == both).all():
            return least
        np.minimum.at(least, left, both)
        np.minimum.at(least, right, both)
        least = least[least]


def _meet(crowd: int | None):
    """Links of a partition sorted by place: (u, v), or (place, free, u) of a crowd."""

    def out(**columns) -> pa.RecordBatch:
        n = len(columns["u"])
        types = {"u": pa.int64(), "v": pa.int64(), "place": pa.int64(), "free": pa.int32()}
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in types.items()], list(types)
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)]
        crowded: int | None = None  # the place whose earlier rows went out as a crowd

        def settle(place, free, fp):
            nonlocal crowded
            bounds = np.flatnonzero(np.diff(place, prepend=place[0] - 1))
            sizes = np.diff(np.append(bounds, len(place)))
            # A crowd's places stay together, and only the first can go on from before.
            big = sizes > crowd if crowd else np.zeros(len(sizes), bool)
            big |= place[bounds] == crowded if crowded is not None else False
            rows = np.repeat(big, sizes)
            if rows.any():
                crowded = int(place[rows][-1])
                yield out(u=fp[rows], place=place[rows], free=free[rows])
            place, fp = place[~rows], fp[~rows]
            if len(fp):
                least = _forest(len(fp), *linked_pairs(fp.view(np.uint64), place))
                joined = np.flatnonzero(least != np.arange(len(fp)))
                yield out(u=fp[joined], v=fp[least[joined]])

        for batch in batches:
            new = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("place", "free", "fp")]
            held = [np.concatenate(x) for x in zip(held, new)]
            # The last place may go on in the next batch; a crowd need not wait.
            last = np.searchsorted(held[0], held[0][-1]) if len(held[0]) else 0
            if crowd and len(held[0]) - last > crowd:
                last = len(held[0])
            if last:
                yield from settle(*(x[:last] for x in held))
                held = [x[last:] for x in held]
        if len(held[0]):
            yield from settle(*held)

    return run


def links(distinct: DataFrame) -> DataFrame:
    """(u, v): links that connect the same distinct fingerprints as all links would."""
    kind = "u long, v long, place long, free int"

    def met(places: DataFrame, crowd: int | None) -> DataFrame:
        return places.repartition("place").sortWithinPartitions("place").mapInArrow(_meet(crowd), kind)

    first = materialise(met(meeting_places(distinct), CROWD), "links")
    crowds = first.where(F.col("place").isNotNull()).select("place", "free", F.col("u").alias("fp"))
    return first.where(F.col("v").isNotNull()).select("u", "v").unionByName(
        met(_finer_places(crowds), None).select("u", "v")
    )


def components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex that each vertex of an edge is connected to.

    Large-star and small-star steps: each links the neighbours of a vertex to the
    smallest of them, until nothing changes. Minima are partial aggregates, so a vertex
    with very many neighbours is combined in the map tasks.
    """
    edges = materialise(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
        "star",
    )
    state, before = _state(edges), None
    while state != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = materialise(larger.distinct(), "star")
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        smaller = smaller.unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialise(smaller.distinct(), "star")
        before, state = state, _state(edges)
    return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    digest = [F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("u", "v"))]
    return tuple(edges.agg(F.count(F.lit(1)), *digest).first())


def label(stored: DataFrame) -> DataFrame:
    """Add component_id to a stored table with the columns doc_id and fp.

    The join back is by fingerprint to one row for each; a fingerprint with a large
    share of the rows is split by adaptive execution.
    """
    distinct = materialise(stored.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = materialise(components(links(distinct)).withColumnRenamed("v", "fp"), "roots")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = named.join(least, "root").select("fp", "component_id", F.col("root").alias("_root"))
    return stored.join(labels, "fp")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    stored = materialise(fingerprints(df, key, text), "fingerprints")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return label(stored).select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, one of each component: the one with the smallest id.

    Rows are numbered in a stored copy, so that of rows with the same id one is kept.
    """
    row = next(n for n in ("_row" + "_" * i for i in range(len(df.columns) + 1)) if n not in df.columns)
    stored = materialise(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    texts.with_workers(df.sparkSession)
    prints = materialise(fingerprints(stored, key, text, row), "fingerprints")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    kept = label(prints).groupBy("_root").agg(F.min(order).alias("_least")).select(F.col("_least._row").alias(row))
    return stored.join(kept, row, "left_semi").select(*[f"`{c}`" for c in df.columns])
