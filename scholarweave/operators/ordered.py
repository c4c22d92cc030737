"""Ordered operations: top-k, compact views, exact samples, trajectories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scholarweave.functions.text import ColumnOrName, col
from scholarweave.workspace import materialise


def compact_view(counts: DataFrame, topics: int = 10, years: int = 5) -> DataFrame:
    """Counts of the most frequent topics in the most recent years, in long form.

    The counts are stored once, since they are read three times. Both selections
    are short lists by construction, so they are broadcast.
    """
    counts = materialise(counts, "counts")
    per_topic = counts.groupBy("topic").agg(F.sum("n").alias("total"))
    top = per_topic.orderBy(F.desc("total"), "topic").limit(topics).select("topic")
    recent = counts.select("year").distinct().orderBy(F.desc("year")).limit(years)
    return counts.join(F.broadcast(top), "topic", "left_semi").join(
        F.broadcast(recent), "year", "left_semi"
    )


def trajectory(series: DataFrame, value: str) -> DataFrame:
    """Consecutive points of a yearly series; one row per year goes in."""
    order = Window.orderBy("year")
    return series.select(
        "year", value,
        F.lag("year").over(order).alias("from_year"),
        F.lag(value).over(order).alias("from_value"),
    )


def sample_n(df: DataFrame, key: str, n: int = 150, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, the same ones on every layout of the data.

    Rows are ordered by a digest of key and seed; each task keeps ``n`` of them.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return df.orderBy(draw, key).limit(n)


def best_per_key(df: DataFrame, key: str, order: Column, kept: list[str]) -> DataFrame:
    """One row per key: the lowest ``order``.

    An aggregate, not a window: it is combined in the map tasks, so a key that
    holds a large share of the rows does not end up in one task.
    """
    best = F.min_by(F.struct(*kept), order).alias("_best")
    return df.groupBy(key).agg(best).select(key, "_best.*")


def limit_per_key(df: DataFrame, key: str, order: list, n: int) -> DataFrame:
    """At most ``n`` rows per key; the limit is applied in the map tasks first."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= n)


def leading(array: ColumnOrName, n: int) -> Column:
    return F.slice(col(array), 1, n)
