"""Token counts by a two-tier lookup of pre-tokens, without shuffling any of them.

A pre-token here is a word of ``wordcodes.pre_tokens``; the tokenizer never merges across
its ends. First tier: the most frequent pre-tokens of the whole table
with their numbers of tokens, a table of at most FREQUENT entries that is broadcast.
Second tier: what is not in it is counted by the library once and kept in a bounded cache
of the worker.

The frequent pre-tokens come from mergeable sketches of fixed size, one for each task,
combined in two steps. They decide how fast a pre-token is counted, never what is counted.

Defined results: a null text is empty, with no bytes and no tokens. Repeated rows give
repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from scholarweave.llm import texts, wordcodes

FREQUENT = 50_000
SKETCHED = 100_000
SKETCH_GROUPS = 64


def frequent_words(df: DataFrame, k: int = FREQUENT, items: int = SKETCHED) -> list[str]:
    """At most ``k`` of the most frequent words of up to LONGEST_CACHED characters."""
    simple = F.regexp_replace(F.lower("text"), wordcodes.APART, "$1 $2")
    words = (
        df.select(F.explode(F.split(simple, r"[\x20\x09-\x0D]+")).alias("word"))
        .where(F.length("word").between(1, wordcodes.LONGEST_CACHED))
        .withColumn("_task", F.spark_partition_id() % SKETCH_GROUPS)
    )
    some = words.groupBy("_task").agg(F.expr(f"approx_top_k_accumulate(word, {items})").alias("sketch"))
    # Grouped, because Spark cannot combine sketches where there are none.
    one = some.groupBy((F.col("_task") * 0).alias("_all")).agg(F.expr(f"approx_top_k_combine(sketch, {items})").alias("sketch"))
    found = one.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {k})")).alias("e")).select("e.item")
    return [r.item for r in found.collect()]


@cache
def _missing(path: str) -> wordcodes.RecentWords:
    """Numbers of tokens as little-endian 32-bit integers, one cache per worker process."""
    encode = wordcodes.library_words(path)
    return wordcodes.RecentWords(lambda words: [len(ids).to_bytes(4, "little") for ids in encode(words)])


def count_tokens(
    df: DataFrame, tokenizer: str, limit: int = 2048, key: str = "doc_id", text: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, n_looked_up): the last counts first-tier hits."""
    docs = texts.id_and_text(df, key, text)
    spark = docs.sparkSession
    words = frequent_words(docs, frequent)
    lengths = [len(ids) for ids in wordcodes.library_words(tokenizer)(words)]
    table = pa.table({"word": pa.array(words, pa.string()), "n": pa.array(lengths, pa.int32())})
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value["word"].combine_chunks()
        sizes = np.append(shared.value["n"].to_numpy(), 0).astype(np.int64)
        missing = _missing(tokenizer)
        for batch in batches:
            for part in texts.slices(batch):
                column = part.column("text")
                found, n_words = wordcodes.pre_tokens(column)
                at = pc.fill_null(pc.index_in(found, value_set=known), len(known)).to_numpy(zero_copy_only=False)
                n = sizes[at]
                rest = np.flatnonzero(at == len(known))
                if len(rest):
                    coded = found.take(pa.array(rest)).dictionary_encode()
                    counted = np.frombuffer(b"".join(missing(coded.dictionary.to_pylist())), "<i4")
                    n[rest] = counted[coded.indices.to_numpy(zero_copy_only=False)]
                doc = np.repeat(np.arange(len(n_words)), n_words)
                total = np.bincount(doc, n, len(n_words)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"),
                    "n_bytes": pc.cast(pc.binary_length(column), pa.int64()),
                    "n_tokens": pa.array(total),
                    "over_limit": pa.array(total > limit),
                    "n_looked_up": pa.array(np.bincount(doc, at < len(known), len(n_words)).astype(np.int64)),
                })

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_looked_up long")
