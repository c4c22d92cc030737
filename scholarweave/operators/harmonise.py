"""Bringing differently shaped tables to one schema, and removing duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from scholarweave import schemas, vocabulary as V
from scholarweave.functions.text import (
    ColumnOrName, blank_to_null, norm_doi, norm_words, strip,
)
from scholarweave.workspace import materialise


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate that is a column of ``df``, by exact name."""
    return next((c for c in candidates if c in df.columns), None)


def harmonise(
    df: DataFrame, aliases: Mapping[str, Sequence[str]] = V.HARMONISED_ALIASES
) -> DataFrame:
    """Map alias columns, ignoring case, to the target columns.

    Values are split at ``;`` and ``,``; the first token over all aliases, in
    priority order, that is neither blank nor "nan" is kept.
    """
    by_lower = {c.lower(): c for c in df.columns}

    def target(sources: Sequence[str]) -> Column:
        present = [by_lower[s.lower()] for s in sources if s.lower() in by_lower]
        if not present:
            return F.lit(None).cast("string")
        return F.coalesce(*[_first_value(F.col(f"`{c}`")) for c in present])

    return df.select(*[target(sources).alias(name) for name, sources in aliases.items()])


def _first_value(c: Column) -> Column:
    parts = F.transform(F.split(c.cast("string"), "[;,]"), strip)
    real = F.filter(parts, lambda p: (p != "") & (F.lower(p) != "nan"))
    return F.try_element_at(real, F.lit(1))


def union_complete(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames that have every harmonised column.

    A frame without a complete row adds none, so it needs no test of its own. Of no
    frames at all the result is empty.
    """
    if not frames:
        columns = ", ".join(f"{c} string" for c in schemas.HARMONISED_COLUMNS)
        return SparkSession.active().createDataFrame([], columns)
    complete = [f.na.drop(subset=schemas.HARMONISED_COLUMNS) for f in frames]
    return reduce(DataFrame.unionByName, complete)


def record_key(doi: Column, title: Column, author: Column) -> Column:
    """Identity of a record: its DOI, or title and author where it has none.

    Takes normalised values. The long text is digested before it is shuffled.
    Null means no identity.
    """
    by_doi = F.concat(F.lit("d"), F.sha2(doi, 256))
    pair = F.concat(title, F.lit("\n"), F.coalesce(author, F.lit("")))
    return F.coalesce(by_doi, F.concat(F.lit("t"), F.sha2(pair, 256)))


def dedupe(
    df: DataFrame,
    id_column: str,
    doi: str = "doi",
    title: str = "title",
    author: str = "author",
) -> DataFrame:
    """One record per identity: the most complete, then the lowest id.

    Per key the lowest id is taken for each possible number of missing fields.
    With numeric ids these are plain numbers, which Spark keeps in hash maps: no
    texts are sorted, and partial aggregation before the shuffle means a record
    with very many copies is no hot spot. The rows themselves are then fetched
    by a semi join on the unique id. A record without identity stays. ``df`` is
    read twice; store it first if it is costly to compute.
    """
    given = [F.when(F.col(f"`{c}`").isNotNull(), 1).otherwise(0) for c in df.columns]
    missing = F.lit(len(given)) - reduce(lambda a, b: a + b, given)
    identity = record_key(norm_doi(doi), norm_words(title), norm_words(author))
    own = F.concat(F.lit("i"), F.col(id_column).cast("string"))
    keyed = df.select(
        F.coalesce(identity, own).alias("_key"), missing.alias("_missing"), F.col(id_column).alias("_id")
    )
    lowest = [
        F.min(F.when(F.col("_missing") == m, F.col("_id"))) for m in range(len(given) + 1)
    ]
    best = keyed.groupBy("_key").agg(F.coalesce(*lowest).alias(id_column)).drop("_key")
    return df.join(best, id_column, "left_semi")


def conform(df: DataFrame, columns: Sequence[str] = schemas.OUTPUT_COLUMNS) -> DataFrame:
    """Exactly ``columns`` in order; the ones that are not there become null."""
    have = set(df.columns)
    return df.select(
        *[
            F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c)
            for c in columns
        ]
    )


def placeholder_records(df: DataFrame) -> DataFrame:
    """Output records made of whatever columns there are, with a default for the rest."""
    have = set(df.columns)

    def pick(name: str, *fallbacks: str, default: str | None = None) -> Column:
        found = next((c for c in (name, *fallbacks) if c in have), None)
        value = F.lit(default) if found is None else F.col(found)
        return value.cast("string").alias(name)

    filled = df.select(
        pick("ProjID"),
        pick("ProjectStatus", default="Unknown"),
        pick("ProjectTitle", "title", default="Unknown"),
        pick("ProjectRDC", default="Unknown"),
        pick("ProjectYearStarted"),
        pick("ProjectYearEnded"),
        pick("ProjectPI", "author", default="Unknown"),
        pick("OutputTitle", "title", default="Unknown"),
        pick("OutputBiblio"),
        pick("OutputType", default="Publication"),
        pick("OutputStatus", default="Unknown"),
        pick("OutputVenue"),
        pick("OutputYear", "year"),
        pick("OutputMonth"),
        pick("OutputVolume"),
        pick("OutputNumber"),
        pick("OutputPages", "OutputPage"),
        pick("DOI"),
        pick("Source"),
    )
    return filled


def render_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Write a sentinel where a text is null or blank; only for sinks that want one."""
    return df.withColumns(
        {c: F.coalesce(blank_to_null(c), F.lit(v)) for c, v in defaults.items()}
    )


def with_constants(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def with_row_numbers(df: DataFrame, order: str, name: str = "row_no") -> DataFrame:
    """Consecutive numbers from 1 in the order of the unique column ``order``.

    Rows are range-partitioned and sorted in parallel, then written once so that
    the split cannot change between the two passes that follow: counting each
    part, and adding to each row the size of the parts before it. The only
    unpartitioned window runs over one row per part.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_parts = (
        df.repartitionByRange(parts, order).sortWithinPartitions(order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    stored = materialise(sorted_parts, "numbered")
    place = F.shiftright(F.col("_at"), 33)
    sizes = stored.groupBy(place.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    # One row per shuffle partition, whatever the data: safe to send to every task.
    return (
        stored.withColumn("_part", place)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1)
        .drop("_part", "_at", "_before")
    )


def proj_id(number: ColumnOrName) -> Column:
    n = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit("PROJ_"), F.lpad(n.cast("string"), _width(n), "0"))


def _width(n: Column) -> Column:
    return F.greatest(F.lit(5), F.length(n.cast("string")))


def with_proj_id(df: DataFrame, order: str) -> DataFrame:
    """``PROJ_00001`` and so on by position; an id that is already there stays."""
    numbered = with_row_numbers(df, order, "_row")
    fresh = proj_id("_row")
    if "ProjID" in df.columns:
        fresh = F.coalesce(blank_to_null("ProjID"), fresh)
    return numbered.withColumn("ProjID", fresh).drop("_row")


def from_row(df: DataFrame, number: ColumnOrName, start: int) -> DataFrame:
    """Rows from position ``start`` on."""
    n = F.col(number) if isinstance(number, str) else number
    return df.where(n >= start)


def last_proj_number(df: DataFrame) -> DataFrame:
    """Highest number among the ids of a sink; files have no last row."""
    n = F.substring_index("ProjID", "_", -1).try_cast("bigint")
    return df.agg(F.coalesce(F.max(n), F.lit(0)).alias("last_number"))
