"""What the text operators share: reading columns, slicing Arrow batches, finding words.

A word is a run of characters other than the six ASCII white-space characters. A
null text counts as the empty text everywhere.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Text bytes that are worked on at once inside a task. A longer document is one slice.
SLICE_BYTES = 4 << 20


def with_workers(spark: SparkSession) -> SparkSession:
    """Let the Python workers import this package from the folder the driver uses.

    A cluster without that folder has the package installed or shipped with
    --py-files; the entry is then only one that is not found.
    """
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, ROOT]))
    return spark


def id_and_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only (doc_id, text), null texts empty; other columns cannot clash with later ones."""
    with_workers(df.sparkSession)
    return df.select(
        F.col(f"`{key}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes in ``column``, in order."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    starts = np.flatnonzero(np.diff(part, prepend=part[0] - 1))
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(start, end - start)


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in one array, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(counts)), counts)
    return flat.filter(pa.array(real)), np.bincount(owner[real], minlength=len(counts)).astype(np.int64)


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Offsets with a leading zero."""
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + counts[i]] for all i, one after the other."""
    ends = np.cumsum(counts, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - counts), counts)
    return values[shift + np.arange(total, dtype=np.int64)]
