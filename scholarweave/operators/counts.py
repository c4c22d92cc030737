"""Counts that are kept up to date by what a run brings, without a recount.

A record has a key and the columns that it is counted by. The latest state of every record
is in a keyed table, so a run reads only the parts of it that may hold its own keys. What a
run changes, one more for the new values of a record and one less for its old ones, is added
to a table of counts, which is summed when it is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scholarweave.sources.stored import KeyedTable, StoredTable
from scholarweave.workspace import materialise


def update_counts(batch: DataFrame, folder: str, key: str, columns: Sequence[str], run: str) -> None:
    """Count the records of ``batch`` into the tables below ``folder``.

    A record that is new is added, one that differs from what was counted before is moved, and
    one whose columns are all null is taken out again. Of several records with a key in one
    batch the smallest counts; records without a key do not. Runs follow each other. A run that
    failed has to be repeated under its name: it then adds what it has not added yet.
    """
    spark = batch.sparkSession
    kinds = dict(batch.dtypes)
    records, counts = KeyedTable(spark, f"{folder}/records", key), StoredTable(spark, f"{folder}/counts")
    known = next((r.number for r in records.runs()[::-1]), 0)
    rows = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*columns)).alias("_new"))
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [key, *columns]) + ", _version bigint"
    before = records.lookup(rows, schema).groupBy(key).agg(F.max_by(F.struct(*columns), "_version").alias("_old"))
    changed = rows.join(before, key, "left").where(~F.col("_new").eqNullSafe(F.coalesce("_old", _nothing(columns, kinds))))
    # Stored: both tables are written from the same rows.
    changed = materialise(changed, "changed")
    steps = changed.select("_new.*", F.lit(1).alias("n")).unionByName(
        changed.where(F.col("_old").isNotNull()).select("_old.*", F.lit(-1).alias("n"))
    )
    there = reduce(Column.__or__, [F.col(f"`{c}`").isNotNull() for c in columns])
    delta = steps.where(there).groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")
    counts.append(delta, run)
    records.append(changed.select(key, "_new.*", F.lit(known + 1).cast("bigint").alias("_version")), run)


def _nothing(columns: Sequence[str], kinds: dict[str, str]) -> Column:
    return F.struct(*[F.lit(None).cast(kinds[c]).alias(c) for c in columns])


def read_counts(spark: SparkSession, folder: str, columns: Sequence[str], schema: str) -> DataFrame:
    """(columns, n) of all combinations that some record has now; ``schema`` is theirs."""
    rows = StoredTable(spark, f"{folder}/counts").read(f"{schema}, n bigint")
    return rows.groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")
