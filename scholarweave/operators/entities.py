"""One record for each thing that several records describe.

Records are the same if they share a key: a DOI, title and author, or an id of another
service. Sharing is carried on: a record with a DOI and one without are the same if a third
one ties both. Records with their keys form a graph, and its components are the entities.
Of an entity every field has the value of its most complete record that has one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from scholarweave.functions.text import norm_doi, norm_words
from scholarweave.operators import graph
from scholarweave.workspace import materialise


def identity_keys(
    doi: str = "doi", title: str | None = "title", author: str | None = "author", ids: Sequence[str] = ()
) -> dict[str, Column]:
    """Named keys of a record; a key is null where part of it is missing.

    A title counts together with an author only: titles such as a bare "Introduction" tie
    what does not belong together.
    """
    keys = {"doi": norm_doi(doi)}
    if title is not None and author is not None:
        keys["title"] = F.concat(norm_words(title), F.lit("\n"), norm_words(author))
    return keys | {name: norm_doi(name) for name in ids}


def resolve(df: DataFrame, id_column: str, keys: Mapping[str, Column]) -> DataFrame:
    """(keys, entity, n) for every set of keys: the entity it belongs to, and its records.

    ``keys`` is the column that :func:`with_key_set` makes. Records with the same keys are one
    vertex, found by partial aggregation, so very many copies of a record are no hot spot.
    """
    sets = with_key_set(df, id_column, keys).groupBy("_keys").agg(F.count(F.lit(1)).alias("n"))
    stored = materialise(sets.withColumn("_v", F.monotonically_increasing_id()), "key-sets")
    return _with_entity(stored).select("_keys", "entity", "n")


def _with_entity(stored: DataFrame) -> DataFrame:
    """A stored table of sets of keys, with the entity that each of them, ``_v``, belongs to."""
    # Digests as bytes: half as long. A key of one set links nothing; most keys are such.
    members = stored.select(F.col("_v").alias("id"), F.explode(F.transform("_keys", F.unhex)).alias("keyword"))
    linked = graph.linked_components(members).withColumnRenamed("id", "_v")
    return stored.join(linked, "_v", "left").withColumn("entity", F.coalesce("component", "_v")).drop("component")


def with_key_set(df: DataFrame, id_column: str, keys: Mapping[str, Column]) -> DataFrame:
    """``df`` with the digests of a record's keys as ``_keys``; one without keys has its own id."""
    digests = F.array(*[F.md5(F.concat(F.lit(f"{name}:"), key).cast("binary")) for name, key in keys.items()])
    own = F.array(F.md5(F.concat(F.lit("own:"), F.col(id_column).cast("string")).cast("binary")))
    there = F.filter(digests, lambda k: k.isNotNull())
    return df.withColumn("_keys", F.when(F.size(there) > 0, F.array_sort(there)).otherwise(own))


def merge(df: DataFrame, id_column: str, keys: Mapping[str, Column]) -> DataFrame:
    """One record for each entity, with all columns of ``df`` and the number of its records.

    The id is the lowest one. Another field has the value of the record with the fewest
    missing fields among those that have one, then of the lowest id. Both aggregations, by
    set of keys and by entity, combine rows before the shuffle; rows are never listed.
    ``df`` is read once: the sets of keys are stored with what their records have. They are
    sorted by a digest, which is cheaper to compare than a list.
    """
    fields = [c for c in df.columns if c != id_column]
    missing = reduce(Column.__add__, [F.col(f"`{c}`").isNull().cast("int") for c in fields], F.lit(0))
    first = lambda c, value: F.min(F.when(value.isNotNull(), F.struct("_missing", F.col(f"`{id_column}`").alias("id"), value.alias("value")))).alias(c)
    keyed = with_key_set(df.withColumn("_missing", missing), id_column, keys)
    by_keys = keyed.groupBy(F.md5(F.array_join("_keys", ",").cast("binary")).alias("_set"), "_keys").agg(
        F.min(f"`{id_column}`").alias(id_column), *[first(c, F.col(f"`{c}`")) for c in fields], F.count(F.lit(1)).alias("_n")
    )
    stored = materialise(by_keys.withColumn("_v", F.monotonically_increasing_id()).drop("_set"), "key-sets")
    by_entity = _with_entity(stored).groupBy("entity").agg(
        F.min(f"`{id_column}`").alias(id_column), *[F.min(f"`{c}`").alias(c) for c in fields], F.sum("_n").alias("n_records")
    )
    return by_entity.select(
        *[F.col(f"`{c}`") if c == id_column else F.col(f"`{c}`")["value"].alias(c) for c in df.columns], "n_records"
    )
