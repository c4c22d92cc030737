"""Token ids in files of word-aligned Simple-8b code.

Each 64-bit word has a selector in its upper four bits. Selectors 1 to 15 say how many
values of which width the other 60 bits hold; selector 0 is the escape for a value of
more than 60 bits and holds its place in the block's list of such values. A block is a
fixed number of ids; the offsets of the blocks' words and escapes stand beside the words,
so any block can be decoded alone and without a loop over its words.

A file is a Parquet file of segments, in ascending order of doc_id from file to file and
row to row. A segment holds whole documents: their ids, block by block, and for each one
doc_id and the number of ids. Parquet serves as the container because Spark commits its
files as a whole: a task that runs again after a lost executor leaves no second copy.

Defined results: a null text is empty and holds only the end id; documents without
doc_id come first; rows with the same doc_id follow each other in the order of their
texts. An empty table gives files without segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from scholarweave.llm import texts, wordcodes

BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 19

# The number and the width of the values of selectors 1 to 15.
COUNTS = np.array([120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

SEGMENT = (
    "part int, first_id long, doc_ids array<long>, doc_tokens array<long>, "
    "block_words array<int>, block_escapes array<int>, n_ids long, words binary, escapes binary"
)


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each unsigned value needs; 0 for 0."""
    values = values.astype(np.uint64)
    high = np.frexp((values >> np.uint64(32)).astype(np.float64))[1]
    low = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(high > 0, high + 32, low).astype(np.uint8)


def _selectors(values: np.ndarray, block: int) -> np.ndarray:
    """The selector that each place would take: the one with the most values that fit."""
    blocks = -(-len(values) // block)
    widest = np.full(blocks * block, 255, np.uint8)  # bits of the widest of the next ``span`` values
    widest[: len(values)] = bit_lengths(values)
    widest, span = widest.reshape(blocks, block), 1
    chosen = np.zeros(widest.shape, np.uint8)
    for k in range(len(COUNTS), 0, -1):
        more = int(COUNTS[k - 1]) - span
        if more >= block:
            break
        if more:  # two windows of the last length make up the longer one
            later = np.full(widest.shape, 255, np.uint8)  # none goes beyond its block
            later[:, :-more] = widest[:, more:]
            widest, span = np.maximum(widest, later), span + more
        fits = widest <= WIDTHS[k - 1]
        if span > 1 and not fits.any():
            break
        chosen[fits] = k
    return chosen.reshape(-1)


def encode_ids(ids: np.ndarray, block: int = BLOCK_IDS) -> dict[str, object]:
    """Blocks of ids, one after the other, with the offsets of their words and escapes."""
    values = ids.astype(np.uint64)
    choice = _selectors(values, block)
    step = np.append(1, COUNTS)[choice].tolist()
    places, at = [], 0
    while at < len(values):
        places.append(at)
        at += step[at]
    starts = np.array(places, np.int64)
    selector = choice[starts]
    words = selector.astype(np.uint64) << np.uint64(60)
    for k in np.unique(selector[selector > 0]).tolist():
        rows = np.flatnonzero(selector == k)
        for j in range(COUNTS[k - 1] if WIDTHS[k - 1] else 0):
            words[rows] |= values[starts[rows] + j] << np.uint64(j * WIDTHS[k - 1])
    bounds = np.append(np.arange(0, len(values), block), len(values))
    escaped = np.flatnonzero(selector == 0)
    first = np.searchsorted(starts[escaped], bounds)
    words[escaped] |= (np.arange(len(escaped)) - first[starts[escaped] // block]).astype(np.uint64)
    return {
        "block_words": np.searchsorted(starts, bounds).tolist(),
        "block_escapes": first.tolist(),
        "n_ids": len(values),
        "words": words.astype("<u8").tobytes(),
        "escapes": values[starts[escaped]].astype("<u8").tobytes(),
    }


def decode_ids(coded: dict, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The ids of a range of blocks of a segment, all by default."""
    bounds = np.array(coded["block_words"], np.int64)
    last_block = len(bounds) - 1 if last_block is None else last_block
    words = np.frombuffer(coded["words"], "<u8")[bounds[first_block] : bounds[last_block]]
    escapes = np.frombuffer(coded["escapes"], "<u8")
    selector = (words >> np.uint64(60)).astype(np.int64)
    starts = texts.starts_of(np.append(1, COUNTS)[selector])
    out = np.zeros(int(starts[-1]), np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for k in np.unique(selector).tolist():
        rows = np.flatnonzero(selector == k)
        if k == 0:
            block = np.searchsorted(bounds, rows + bounds[first_block], side="right") - 1
            base = np.array(coded["block_escapes"], np.int64)[block]
            out[starts[rows]] = escapes[base + payload[rows].astype(np.int64)]
        elif WIDTHS[k - 1]:
            mask = np.uint64((1 << int(WIDTHS[k - 1])) - 1)
            for j in range(COUNTS[k - 1]):
                out[starts[rows] + j] = (payload[rows] >> np.uint64(j * WIDTHS[k - 1])) & mask
    return out


def _segments(rows: Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("part", pa.int32()), ("first_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())), ("block_words", pa.list_(pa.int32())),
        ("block_escapes", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("words", pa.binary()),
        ("escapes", pa.binary()),
    ])
    part, before = TaskContext.get().partitionId(), 0
    docs: list[int] = []
    counts: list[int] = []
    held: list[np.ndarray] = []

    def segment() -> pa.RecordBatch:
        ids = np.concatenate(held)
        row = {"part": part, "first_id": before, "doc_ids": docs, "doc_tokens": counts} | encode_ids(ids)
        return pa.RecordBatch.from_pylist([row], schema)

    for batch, ids, starts in rows:
        docs, counts = docs + batch.column("doc_id").to_pylist(), counts + np.diff(starts).tolist()
        held.append(ids)
        if sum(map(len, held)) >= SEGMENT_IDS:
            yield segment()
            before += sum(map(len, held))
            docs, counts, held = [], [], []
    if docs:
        yield segment()


def write_ids(
    df: DataFrame, tokenizer: str, folder: str, end_id: int = 1, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode the texts, each followed by ``end_id``, and write them in doc_id order.

    Range partitioning puts neighbouring documents into one file; the number of files
    follows spark.sql.shuffle.partitions and the adaptive settings. Rows of one doc_id stand
    in the order of the beginnings of their texts, and within a file of their texts. A range
    may end between them, and between equal rows, too, which only chance tells apart, so that
    no doc_id makes a file large.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = wordcodes.library_encoder(tokenizer)
        yield from _segments(wordcodes.encoded_slices(batches, encoder, end_id))

    by_id = F.col("doc_id").asc_nulls_first()
    placed = texts.id_and_text(df, key, text).withColumns({"_start": F.substring("text", 1, 8), "_chance": F.rand(7)})
    ordered = placed.repartitionByRange(by_id, "_start", "_chance").drop("_start", "_chance").sortWithinPartitions(by_id, "text")
    ordered.mapInArrow(run, SEGMENT).write.option("compression", "none").parquet(folder)


def read_documents(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids array<long>) of all documents in the files.

    ``start`` is the number of ids of all documents before; the files' totals, one row
    for each file, are the only thing that is summed over all files.
    """
    return _located(spark, folder, "ids array<long>", lambda ids: pa.array(ids.astype(np.int64)).tolist())


def read_checksums(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the decoded files."""
    return _located(spark, folder, "ids_crc32 long", wordcodes.crc32)


def _located(spark, folder: str, column: str, value) -> DataFrame:
    texts.with_workers(spark)
    stored = spark.read.schema(SEGMENT).parquet(folder)
    name, kind = column.split(" ")
    types = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_ids(row)
                starts = texts.starts_of(np.array(row["doc_tokens"], np.int64))
                values = [value(ids[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(values), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts[:-1] + row["first_id"], pa.int64()),
                        pa.array(row["doc_tokens"], pa.int64()),
                        pa.array(values, types[kind]),
                    ],
                    ["part", "doc_id", "_local", "n_tokens", name],
                )

    decoded = stored.mapInArrow(run, f"part int, doc_id long, _local long, n_tokens long, {column}")
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # One row for each file: small against the files by construction.
    return decoded.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("_base") + F.col("_local")).alias("start"), "n_tokens", name
    )
