"""CSV and Parquet scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scholarweave.functions.predicates import is_present
from scholarweave.sources import csv_records
from scholarweave.sources.stored import StoredTable, list_paths


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, one_line: bool = False
) -> DataFrame:
    """CSV with a header and a given schema: no pass over the data to guess types.

    Quoted fields may span lines, and files are split all the same. ``one_line`` says that
    no field does: Spark's own reader then takes each line for a record, which tears those
    that are not one line, and saves the pass that looks for quotes.
    """
    if one_line:
        return _csv(spark).schema(schema).csv(path)
    return csv_records.parsed(csv_records.csv_records(spark, path), _ddl(schema))


def read_csv_text(
    spark: SparkSession, path: str, one_line: bool = False, states: csv_records.QuoteStates | None = None
) -> DataFrame:
    """CSV with every column as text, named by the header as Spark names columns."""
    # Of the file only the first record is read here, line breaks in it included.
    named = _csv(spark).option("inferSchema", False).option("multiLine", not one_line).csv(path)
    if one_line:
        return named
    return csv_records.parsed(csv_records.csv_records(spark, path, states=states), _ddl(named.schema))


def _ddl(schema: str | T.StructType) -> str:
    if isinstance(schema, str):
        return schema
    quoted = lambda name: "`" + name.replace("`", "``") + "`"
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)


def _csv(spark: SparkSession):
    # Quotes inside fields are doubled.
    return spark.read.option("header", True).option("quote", '"').option("escape", '"')


def read_group_files(spark: SparkSession, pattern: str, one_line: bool = False) -> list[DataFrame]:
    """One frame per file matching ``pattern``, since their headers differ.

    Files that are not there simply do not match. Frames stay separate until
    each has been harmonised; quotes are looked for in all files at once.
    """
    paths = list_paths(spark, pattern)
    states = csv_records.QuoteStates(spark, paths) if paths and not one_line else None
    return [read_csv_text(spark, path, one_line, states) for path in paths]


def read_done_keys(spark: SparkSession, sink: str, key: Column | str) -> DataFrame | None:
    """The keys that runs have written, or None before the first one."""
    rows = read_sink(spark, sink)
    return None if rows is None else rows.select(key)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace ``path`` by CSV with a header."""
    (
        df.write.mode("overwrite").option("header", True)
        .option("quote", '"').option("escape", '"').csv(path)
    )


def append(df: DataFrame, sink: str, run: str | None = None) -> bool:
    """Add a batch to a sink, as a whole or not at all.

    A run that has a name adds its batch once, however often it is repeated.
    """
    return StoredTable(df.sparkSession, sink).append(df, run)


def read_sink(spark: SparkSession, sink: str, schema: str | T.StructType | None = None) -> DataFrame | None:
    """Rows of a sink; before the first batch none, or None without a schema."""
    return StoredTable(spark, sink).read(schema)


def write_matrix(matrix: DataFrame, path: str) -> None:
    """One CSV file of a matrix, which is as small as its two dimensions."""
    matrix.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """Nested JSON of a one-row summary."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    return df.limit(rows)


def present_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in all, and per column the rows that are neither null nor blank; one pass."""
    counts = [F.count_if(is_present(c)).alias(c) for c in columns]
    return df.agg(F.count(F.lit(1)).alias("rows"), *counts)
