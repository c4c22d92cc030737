"""Landed API responses: JSON and XML bodies parsed with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scholarweave import schemas
from scholarweave.functions.text import ColumnOrName, col, norm_doi


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored responses, one row each."""
    return spark.read.format(fmt).schema(schemas.LANDED_PAYLOAD).load(path)


def parse_json(body: ColumnOrName, schema: str) -> Column:
    """Struct of a JSON body; malformed text gives null fields and never fails the job."""
    return F.from_json(col(body), schema, {"mode": "PERMISSIVE"})


def parse_xml(body: ColumnOrName, schema: str) -> Column:
    """Struct of an XML body; malformed text gives null fields and never fails the job."""
    return F.from_xml(col(body), schema, {"mode": "PERMISSIVE"})


def is_answer(body: ColumnOrName = "body") -> Column:
    """A stored answer with code 200, without error and with a body."""
    body = col(body)
    return F.coalesce(
        (F.col("code") == 200) & F.col("error").isNull() & (F.trim(body) != ""), F.lit(False)
    )


def parsed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that filters on it do not compute a second time.

    The optimiser copies an expression into the filters it pushes below a
    projection, but pushes nothing below the generator that yields it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def first_per_key(
    landed: DataFrame, key: ColumnOrName = "key", rank: Column | None = None
) -> DataFrame:
    """One stored response per normalised key, whatever number was landed.

    The one with the lowest ``rank`` wins, by default a usable answer; then the
    lowest code, and a body before none. Partial aggregation keeps a key with very
    many responses from gathering in one task.
    """
    fields = [c for c in landed.columns if c not in ("key", "source")]
    if rank is None:
        rank = F.when(is_answer(), 0).otherwise(1)
    code = F.coalesce(F.col("code"), F.lit(1 << 30))
    order = F.struct(rank, code, F.col("body").isNull(), "body", "error")
    kept = F.min_by(F.struct(*fields), order)
    return (
        landed.groupBy(norm_doi(key).alias("lookup_key")).agg(kept.alias("kept"))
        .where(F.col("lookup_key").isNotNull())
        .select("lookup_key", "kept.*")
    )
