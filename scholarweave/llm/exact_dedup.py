"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when they are identical without the six ASCII white-space characters.

1. A first scan gives the normalised length and a hash of the first ``PREFIX_BYTES``
   normalised bytes of each text, a few bytes a row. Rows are counted by length.
2. Those whose length occurs more than once are counted by length and prefix hash.
3. A second scan takes the SHA-256 of the whole text of those rows only whose length and
   prefix hash occur more than once. Rows with equal digests are the groups; every other
   row is a group of its own and is never shuffled.

What survives a step reaches the next one as a bitmap of fixed largest size
(:class:`~scholarweave.llm.spread.KeyFilter`), so no text is shuffled or stored. A row that
the bitmap lets through by chance is hashed in vain and then is alone with its digest.

Of equal texts the row with the most code points in its original text stays, then the one
with the smallest id, a missing id last; of rows that are equal in both, one stays.

Defined results: a null text is the empty text; empty texts and those of white space alone
are one group. Repeated rows and repeated ids are rows of their own. A text of any length is
read whole. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from scholarweave.llm import texts
from scholarweave.llm.spread import KeyFilter, join_unique
from scholarweave.workspace import materialise

WHITE = b" \t\n\x0b\x0c\r"
PREFIX_BYTES = 256

_FOUND = "doc_id long, row long, chars long, full binary"


def _read(df: DataFrame, key: str, text: str, row: str | None) -> DataFrame:
    """(doc_id, row, chars, text): texts as bytes, so that none is altered on its way."""
    texts.with_workers(df.sparkSession)
    number = F.col(f"`{row}`") if row else F.monotonically_increasing_id()
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(
        F.col(f"`{key}`").cast("bigint").alias("doc_id"), number.alias("row"),
        F.length(whole).cast("bigint").alias("chars"), whole.cast("binary").alias("text"),
    )


def _signature(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Length and prefix hash of normalised texts."""
    length = np.fromiter(map(len, bodies), np.int64, len(bodies))
    prefix = np.fromiter((xxhash.xxh64_intdigest(b[:PREFIX_BYTES]) for b in bodies), np.uint64, len(bodies))
    return length, prefix.view(np.int64)


def _mixed(length: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    return prefix ^ (length * np.int64(-7046029254386353131))


def _bodies(batch: pa.RecordBatch) -> list[bytes]:
    return [t.translate(None, WHITE) for t in batch.column("text").to_pylist()]


def signatures(df: DataFrame) -> DataFrame:
    """(length, prefix) of each row of :func:`_read`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch):
                length, prefix = _signature(_bodies(part))
                yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(prefix)], ["length", "prefix"])

    return df.select("text").mapInArrow(run, "length long, prefix long")


def surviving(signed: DataFrame) -> KeyFilter:
    """Filter of the pairs of length and prefix hash that more than one row may have."""
    spark = signed.sparkSession
    often = lambda keys: signed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    lengths = materialise(often(["length"]).select("length"), "lengths")
    shared = spark.sparkContext.broadcast(KeyFilter(lengths, "length"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, prefix = (batch.column(c).to_numpy() for c in ("length", "prefix"))
            keep = shared.value.may_have(length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[keep]) for v in (length, prefix, _mixed(length, prefix))], ["length", "prefix", "mixed"]
            )

    refined = signed.mapInArrow(run, "length long, prefix long, mixed long")
    pairs = refined.groupBy("length", "prefix").agg(F.first("mixed").alias("mixed"), F.count(F.lit(1)).alias("_n"))
    return KeyFilter(materialise(pairs.where("_n > 1").select("mixed"), "prefixes"), "mixed")


def _hashed(df: DataFrame, filter_: KeyFilter, digest: bool) -> DataFrame:
    """Rows with the full hash of the surviving ones, null for the others."""
    survivors = df.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch):
                bodies = _bodies(part)
                keep = survivors.value.may_have(_mixed(*_signature(bodies)))
                hashes = [hashlib.sha256(b).digest() if k or digest else None for b, k in zip(bodies, keep)]
                full = pa.array([h if k else None for h, k in zip(hashes, keep)], pa.binary())
                columns = [*(part.column(c) for c in ("doc_id", "row", "chars")), full]
                names = ["doc_id", "row", "chars", "full"]
                if digest:
                    columns, names = [*columns, pa.array([h.hex() for h in hashes], pa.string())], [*names, "text_sha256"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(run, _FOUND + (", text_sha256 string" if digest else ""))


def _verdicts(df: DataFrame, key: str, text: str, digest: bool, row: str | None = None) -> DataFrame:
    read = _read(df, key, text, row)
    signed = materialise(signatures(read), "signatures")
    # Stored, because row numbers must be the same wherever they are used.
    rows = materialise(_hashed(read, surviving(signed), digest), "hashed")
    shown = ["doc_id", "keep_id", "group_size", "kept", *(["text_sha256"] if digest else []), "row"]
    alone = rows.where(F.col("full").isNull()).select(
        "*", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept")
    )
    several = rows.where(F.col("full").isNotNull())
    best = F.min(F.struct(-F.col("chars"), F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
    groups = several.groupBy("full").agg(best, F.count(F.lit(1)).alias("group_size")).select(
        "full", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("_kept_row"), "group_size"
    )
    judged = join_unique(several, groups, ["full"], F.xxhash64("row")).withColumn("kept", F.col("row") == F.col("_kept_row"))
    return alone.select(*shown).unionByName(judged.select(*shown))


def find_copies(df: DataFrame, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept) of every row; with ``digest`` the SHA-256 of each
    normalised text, too, which does not take part in the grouping."""
    return _verdicts(df, key, text, digest).drop("row")


def keep_one_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns. A stored copy has their numbers."""
    row = next(n for n in ("_row" + "_" * i for i in range(len(df.columns) + 1)) if n not in df.columns)
    stored = materialise(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    stay = _verdicts(stored, key, text, False, row).where("kept").select(F.col("row").alias(row))
    return stored.join(stay, row, "left_semi").select(*[f"`{c}`" for c in df.columns])
