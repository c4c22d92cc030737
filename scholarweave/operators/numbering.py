"""Ids that a key keeps over all runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholarweave.operators.harmonise import last_proj_number, proj_id, with_row_numbers
from scholarweave.sources.stored import KeyedTable


def stable_ids(keys: DataFrame, key: str, registry: str, buckets: int | None = None) -> DataFrame:
    """(key, ProjID) of the distinct keys; null keys get none.

    ``registry`` is a keyed table of all ids given so far. A key that is in it keeps its id,
    whatever else the input holds; new keys get the numbers after the highest one, in their
    order. Runs that share a registry have to follow each other. Repeating a run that failed
    gives the same ids.
    """
    spark = keys.sparkSession
    table = KeyedTable(spark, registry, key, buckets)
    wanted = keys.select(key).na.drop().distinct()
    fresh = table.missing(wanted)
    filled = [run for run in table.runs() if run.facts["rows"]]
    # Numbers only grow, so the newest run that gave any has the highest.
    last = last_proj_number(table.read_run(filled[-1])).first().last_number if filled else 0
    numbered = with_row_numbers(fresh, key, "_row")
    table.append(numbered.select(key, proj_id(F.col("_row") + last).alias("ProjID")))
    return KeyedTable(spark, registry, key).lookup(wanted, f"`{key}` {dict(keys.dtypes)[key]}, ProjID string")
