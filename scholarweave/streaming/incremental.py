"""Resumable processing: a run adds only what earlier runs have not written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarweave.functions.text import norm_doi
from scholarweave.sources.stored import KeyedTable


def append_new(batch: DataFrame, sink: str, key: str, run: str | None = None, buckets: int | None = None) -> bool:
    """Append the rows of ``batch`` whose normalised key is not in the sink, a keyed table.

    Of several rows with one key the one with the fewest gaps is kept, then the
    smallest, chosen by partial aggregation. Only the parts of the sink that may hold keys of
    the batch are read. A run that fails leaves the sink as it was; running again picks up
    what is missing. False if a run of this name was there before.
    """
    others = [c for c in batch.columns if c != key]
    gaps = F.size(F.filter(F.array(*[F.col(f"`{c}`").isNull() for c in others]), lambda gap: gap)) if others else F.lit(0)
    fresh = (
        batch.withColumn(key, norm_doi(F.col(key).cast("string")))
        .where(F.col(key).isNotNull())
        .groupBy(key).agg(F.min_by(F.struct(*others), F.struct(gaps, *others)).alias("_row"))
        .select(key, "_row.*")
    )
    table = KeyedTable(batch.sparkSession, sink, key, buckets)
    return table.append(table.missing(fresh), run)


def stream_new(
    spark: SparkSession, source: str, schema, sink: str, checkpoint: str, keys: list[str], name: str = "stream", buckets: int | None = None
) -> None:
    """Work off all files landed in ``source`` since the last run, then stop.

    Text keys are normalised as in :func:`append_new`, and rows without a key are left
    out. The checkpoint remembers the files read. What has been seen is known from the sink,
    a keyed table, so the stream holds no state, however many keys there are and however late
    one turns up again; of rows with the same key one that landed first stays. Each batch is
    a run of the sink named after ``name`` and its number: a batch that Spark repeats
    after a failure adds nothing twice.
    """
    rows = spark.readStream.schema(schema).parquet(source)
    kinds = dict(rows.dtypes)
    rows = rows.withColumns({k: norm_doi(k) for k in keys if kinds[k] == "string"}).na.drop(subset=keys)

    def add(batch: DataFrame, number: int) -> None:
        table = KeyedTable(spark, sink, keys, buckets)
        table.append(table.missing(batch.dropDuplicates(keys)), f"{name}-{number}")

    query = (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
