"""Counts, pivots, totals and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from scholarweave.functions.predicates import is_present
from scholarweave.functions.text import year_column

YEARS_AT_ONCE = 10_000


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value, most frequent first; nulls are left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def top_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; ties go by value. Only ``n`` rows per task are kept."""
    return value_counts(df, key).limit(n)


def usable_years(df: DataFrame, year: str, topic: str, since: int | None = None) -> DataFrame:
    """(year, topic) of rows whose year is a number and whose topic is known."""
    kept = df.select(year_column(df, year).alias("year"), F.col(topic).alias("topic")).where(
        F.col("year").isNotNull() & F.col("topic").isNotNull()
    )
    return kept if since is None else kept.where(F.col("year") >= since)


def year_topic_counts(pairs: DataFrame) -> DataFrame:
    """Long count table: the form for any number of topics and years, which every matrix
    below is made from."""
    return pairs.groupBy("year", "topic").agg(F.count(F.lit(1)).alias("n"))


def spread_counts(
    counts: DataFrame, row: str, column: str, values: Sequence, prefix: str = ""
) -> DataFrame:
    """Wide form of a long count table for given ``values``, gaps filled with 0.

    Values become columns, so the caller names them; they are never gathered from the data.
    """
    cells = [
        F.coalesce(F.sum(F.when(F.col(column) == F.lit(v), F.col("n"))), F.lit(0)).alias(
            f"{prefix}{v}"
        )
        for v in values
    ]
    return counts.groupBy(row).agg(*cells)


def year_by_topic(pairs: DataFrame, topics: Sequence[str]) -> DataFrame:
    return spread_counts(year_topic_counts(pairs), "year", "topic", topics)


def topic_by_year(pairs: DataFrame, years: Sequence[int]) -> DataFrame:
    return spread_counts(year_topic_counts(pairs), "topic", "year", years, prefix="y")


def crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts for given values that keep rows and columns without one, as their own category."""
    counts = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    cells = [
        F.coalesce(F.sum(F.when(F.col(column) == F.lit(v), F.col("n"))), F.lit(0)).alias(str(v))
        for v in values
    ]
    missing = F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("n"))), F.lit(0))
    return counts.groupBy(row).agg(*cells, missing.alias("missing"))


def matrix_totals(counts: DataFrame) -> DataFrame:
    """Totals per topic and per year of a long count table, in one pass."""
    totals = counts.groupingSets([["topic"], ["year"]], "topic", "year").agg(
        F.sum("n").alias("n"), F.grouping("topic").alias("_by_year")
    )
    return totals.select(
        F.when(F.col("_by_year") == 1, "year").otherwise("topic").alias("axis"),
        F.coalesce(F.col("topic"), F.col("year").cast("string")).alias("value"),
        "n",
    )


def matrix_shape(counts: DataFrame) -> DataFrame:
    """Number of topics and years, first and last year."""
    return counts.agg(
        F.count_distinct("topic").alias("topics"),
        F.count_distinct("year").alias("years"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def outputs_by_year(df: DataFrame, year: str) -> DataFrame:
    return (
        df.select(year_column(df, year).alias("year")).where(F.col("year").isNotNull())
        .groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    )


def active_by_year(projects: DataFrame, start: str, end: str) -> DataFrame:
    """Projects running in each year of the overall span.

    Each project gives one +1 at its start and one -1 after its end. These are
    summed per year before anything is ordered, so the running total covers one
    row per year with a change. Each gap to the next such year is then filled, in
    portions, so no array spans all years.
    """
    s, e = year_column(projects, start), year_column(projects, end)
    valid = projects.select(s.alias("s"), e.alias("e")).where(F.col("s") <= F.col("e"))
    steps = valid.select(
        F.explode(
            F.array(
                F.struct(F.col("s").alias("year"), F.lit(1).alias("step")),
                F.struct((F.col("e") + 1).alias("year"), F.lit(-1).alias("step")),
            )
        ).alias("x")
    ).select("x.*")
    net = steps.groupBy("year").agg(F.sum("step").alias("step"))
    order = Window.orderBy("year")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gaps = net.select(
        "year", F.sum("step").over(running).alias("n"), (F.lead("year").over(order) - 1).alias("until")
    ).where(F.col("until").isNotNull())
    portions = gaps.select("n", "until", F.explode(F.sequence("year", "until", F.lit(YEARS_AT_ONCE))).alias("first"))
    last = F.least(F.col("until"), F.col("first") + (YEARS_AT_ONCE - 1))
    return portions.select(F.explode(F.sequence("first", last)).alias("year"), "n")


def peak(series: DataFrame) -> DataFrame:
    """Highest value with its earliest year, and the value of the last year."""
    return series.agg(
        F.max_by("year", F.struct("n", -F.col("year"))).alias("peak_year"),
        F.max("n").alias("peak_value"),
        F.max_by("n", "year").alias("current_value"),
    )


def summary_document(series: DataFrame) -> DataFrame:
    """One nested row: the yearly series and its peak. A series has one row per year."""
    points = F.array_sort(F.collect_list(F.struct("year", "n")))
    return series.agg(
        F.struct(points.alias("publications_by_year")).alias("plots"),
        F.struct(
            F.max_by("year", F.struct("n", -F.col("year"))).alias("peak_year"),
            F.max("n").alias("peak_value"),
            F.max_by("n", "year").alias("current_value"),
        ).alias("stats"),
    )


def match_summary(matches: DataFrame) -> DataFrame:
    """Outcomes of a matching run by flag, method and reason."""
    return matches.groupBy("In_PMC", "Method", "Reason").agg(F.count(F.lit(1)).alias("n"))


def count_where(df: DataFrame, **conditions: Column) -> DataFrame:
    """All rows and the rows meeting each condition, in one pass."""
    counts = [F.count_if(cond).alias(name) for name, cond in conditions.items()]
    return df.agg(F.count(F.lit(1)).alias("total"), *counts)


def funnel_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows left after each of the successive presence filters, from one aggregation."""
    passed = F.lit(True)
    counts = [F.count(F.lit(1)).alias("step_0")]
    for i, c in enumerate(columns, start=1):
        passed = passed & is_present(c)
        counts.append(F.count_if(passed).alias(f"step_{i}"))
    row = df.agg(*counts)
    steps = [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("after"), F.col(f"step_{i}").alias("n"))
        for i, name in enumerate(["all rows", *columns])
    ]
    return row.select(F.inline(F.array(*steps)))


def funnel_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows that pass every step."""
    return df.where(reduce(lambda a, b: a & b, [is_present(c) for c in columns]))


def year_column_profile(df: DataFrame, low: int = 1900, high: int = 2030) -> DataFrame:
    """Numeric columns whose whole range could be years, with that range; one pass."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    aggregates = [
        F.struct(
            F.lit(c).alias("column"),
            F.min(F.col(c).cast("double")).alias("low"),
            F.max(F.col(c).cast("double")).alias("high"),
        )
        for c in numeric
    ]
    ranges = df.agg(F.array(*aggregates).alias("r")).select(F.inline("r"))
    return ranges.where((F.col("low") >= low) & (F.col("high") <= high))

