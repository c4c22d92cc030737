"""Quality rules: word statistics and compression bands.

Text that repeats itself compresses far better than prose, and encoded or random
data hardly at all. Both show in the ratio of zstandard-compressed to plain UTF-8
bytes, which also depends on the length: short texts give the compressor little to
refer back to. So each length has its own band of acceptable ratios. The ratio is
taken of the whole document and of every fixed chunk, because a long document can
hide a repetitive part in a good average. The last chunk reaches back into the one
before it, so that all chunks have one length and one band.

The ratio alone takes dense scripts for noise and hexadecimal digits for prose. So what
is above the band is also compared with the same bytes in another order: noise
compresses no better than those, language does, the longer the clearer. The limits lie
between the two, measured on noise and on English, code, mark-up and thirteen
translations. They tell base64, random characters and random mixed tokens from 100
bytes, random lower-case tokens from 1,024, lines of hexadecimal digits from 1,280 and
hexadecimal pairs from 3,072; shorter ones of these compress like prose and pass.

Everything is per document: the plan is a scan and a map, without any shuffle.

Defined results: a null text is empty and has no words. A text below the shortest
band has no verdict of the bands. Repeated rows give repeated results; an empty
table gives an empty one. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from scholarweave.llm import texts


@dataclass(frozen=True)
class Rules:
    """Limits of the rules.

    ``bands`` lists (least bytes, least ratio, greatest ratio, greatest share) in rising
    order; a text or chunk belongs to the last one that it reaches. It is outside if its
    ratio is below the least, or above the greatest while it also takes more than the
    greatest share of what its shuffled bytes compress to. Texts longer than a chunk are
    compared with shuffled bytes by their chunks. ``max_chunks_outside`` is a number of
    chunks, whatever the length; of fewer than four chunks none may be outside.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    level: int = 3
    chunk_bytes: int = 4096
    max_chunks_outside: float = 1
    bands: tuple[tuple[int, float, float, float], ...] = (
        (100, 0.40, 1.04, 0.985),
        (112, 0.40, 0.99, 0.985),
        (128, 0.40, 0.97, 0.985),
        (150, 0.40, 0.92, 0.985),
        (200, 0.40, 0.87, 0.985),
        (256, 0.35, 0.84, 0.985),
        (384, 0.35, 0.80, 0.985),
        (512, 0.30, 0.77, 0.985),
        (768, 0.30, 0.74, 0.980),
        (1024, 0.25, 0.605, 0.980),
        (1280, 0.25, 0.44, 0.975),
        (1536, 0.25, 0.44, 0.960),
        (2048, 0.25, 0.44, 0.955),
        (3072, 0.25, 0.44, 0.915),
        (3328, 0.25, 0.44, 0.905),
        (4096, 0.20, 0.44, 0.900),
    )


def word_statistics(batch_texts: pa.Array, window: int = 5) -> dict[str, np.ndarray]:
    """Counts per text: words, their characters, symbols, repeated lines, repeated words."""
    words, n_words = texts.word_lists(batch_texts)
    n = len(batch_texts)
    doc = np.repeat(np.arange(n), n_words)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    symbols = pc.count_substring_regex(batch_texts, "[#*$%&|<>]")
    return {
        "n_words": n_words,
        "word_chars": np.bincount(doc, chars, n).astype(np.int64),
        "n_symbols": symbols.to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": _repeated_lines(batch_texts, n),
        "n_repeat_words": _repeated_words(words, n_words, doc, window),
    }


def _repeated_lines(batch_texts: pa.Array, n: int) -> np.ndarray:
    lists = pc.split_pattern(batch_texts, "\n")
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    lines, doc = lists.flatten(), np.repeat(np.arange(n), counts)
    real = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    doc, lines = doc[real], lines.filter(pa.array(real))
    code = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = doc * (len(lines) + 1) + code
    first = np.unique(key, return_index=True)[1]
    return np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)


def _repeated_words(words: pa.Array, n_words: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """Words in windows of ``window`` words that occur at least twice in their text.

    Windows are numbered exactly: the number of a window of k words and the number of
    its last word make the number of a window of k + 1 words.
    """
    n, total = len(n_words), len(words)
    if total < window:
        return np.zeros(n, np.int64)
    code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = int(code.max()) + 1
    last = texts.starts_of(n_words)[1:]
    number = doc * size + code  # windows of one word, apart for each text
    at = np.arange(total)
    for k in range(1, window):
        inside = at + k < last[doc[at]]
        at, number = at[inside], number[inside]
        number = pd.factorize(number)[0].astype(np.int64) * size + code[at + k]
    _, where, times = np.unique(number, return_inverse=True, return_counts=True)
    hit = at[times[where] > 1]
    step = np.zeros(total + 1, np.int64)  # +1 where a repeated window begins, -1 behind it
    np.add.at(step, hit, 1)
    np.add.at(step, hit + window, -1)
    return np.bincount(doc, np.cumsum(step[:-1]) > 0, n).astype(np.int64)


@lru_cache(maxsize=256)
def _order(n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(n)).permutation(n)


def compression(raw: bytes, rules: Rules, compressor) -> tuple[float | None, int, int, bool]:
    """(ratio, chunks, chunks outside their band, passes) of one text."""

    def inside(part: bytes) -> tuple[float | None, bool]:
        if not part:
            return None, True
        size = len(compressor.compress(part))
        ratio = size / len(part)
        band = next((b for b in reversed(rules.bands) if len(part) >= b[0]), None)
        if band is None or band[1] <= ratio <= band[2]:
            return ratio, True
        if ratio < band[1] or len(part) > rules.chunk_bytes:
            return ratio, ratio >= band[1]
        shuffled = np.frombuffer(part, np.uint8)[_order(len(part))].tobytes()
        return ratio, size <= band[3] * len(compressor.compress(shuffled))

    ratio, good = inside(raw)
    if len(raw) <= rules.chunk_bytes:
        return ratio, 0, 0, good
    view = memoryview(raw)
    last = len(raw) - rules.chunk_bytes
    starts = [*range(0, last, rules.chunk_bytes), last]
    outside = sum(not inside(view[i : i + rules.chunk_bytes])[1] for i in starts)
    return ratio, len(starts), outside, good and outside <= min(rules.max_chunks_outside, len(starts) // 4)


def _judge(part: pa.RecordBatch, column: str, rules: Rules, compressor) -> dict[str, list | np.ndarray]:
    found = word_statistics(part.column(column), rules.window)
    raw = pc.cast(part.column(column), pa.binary())
    bands = [compression(x.as_py(), rules, compressor) for x in raw]
    failed = (found["n_words"] < rules.min_words) | (
        100 * found["n_repeat_words"] > rules.max_repeat_percent * found["n_words"]
    )
    good = np.array([b[3] for b in bands], bool)
    return found | {
        "base_failed": failed,
        "kept": ~failed & good,
        "ratio": [b[0] for b in bands],
        "n_chunks": [b[1] for b in bands],
        "n_chunks_outside": [b[2] for b in bands],
    }


RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, ratio double, n_chunks long, "
    "n_chunks_outside long"
)


def score_documents(
    df: DataFrame, key: str = "doc_id", text: str = "text", rules: Rules = Rules()
) -> DataFrame:
    """One row per document with its statistics, ratios and verdict (columns of RESULT)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            for part in texts.slices(batch):
                found = _judge(part, "text", rules, compressor)
                ids = {"doc_id": part.column("doc_id")}
                yield pa.RecordBatch.from_pydict(ids | {k: pa.array(v) for k, v in found.items()})

    return texts.id_and_text(df, key, text).mapInArrow(run, RESULT)


def keep_good(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``df`` that the rules keep, with all their columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            for part in texts.slices(batch, text):
                filled = pa.RecordBatch.from_arrays([pc.fill_null(part.column(text), "")], [text])
                yield part.filter(pa.array(_judge(filled, text, rules, compressor)["kept"]))

    texts.with_workers(df.sparkSession)
    return df.mapInArrow(run, df.schema)
