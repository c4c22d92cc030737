"""The whole run: harmonise, look up, extract, combine, analyse."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarweave import schemas, vocabulary as V
from scholarweave.functions import text
from scholarweave.operators import communities, entities, frequency, graph, harmonise, lifecycle, match, numbering
from scholarweave.plans import records
from scholarweave.sources import payloads, tables
from scholarweave.sources.payloads import first_per_key
from scholarweave.sources.stored import KeyedTable
from scholarweave.workspace import materialise


def combine(by_source: Mapping[str, DataFrame], transitive: bool = False) -> DataFrame:
    """Records of all sources in one table, named by source and without duplicates.

    Records that are the same output (by DOI, else by title and lead) are kept
    once, in the most complete form. ProjID is unique within a source. With ``transitive``
    every record that shares a DOI, or title and lead, with another is the same output, and
    its fields are put together from all of them.
    """
    named = [
        harmonise.conform(df).withColumn("Source", F.lit(name)) for name, df in by_source.items()
    ]
    every = reduce(DataFrame.unionByName, named).withColumn("_id", F.concat_ws(":", "Source", "ProjID"))
    # Stored, so that the payloads are parsed once for both sides of the semi join, and
    # records without an output dropped from what is stored: for a filter before, Spark
    # would parse the payloads again.
    keyed = materialise(every, "records").where(F.col("OutputTitle").isNotNull())
    if transitive:
        keys = entities.identity_keys("DOI", "OutputTitle", "ProjectPI")
        return entities.merge(keyed, "_id", keys).drop("_id", "n_records")
    kept = harmonise.dedupe(keyed, "_id", doi="DOI", title="OutputTitle", author="ProjectPI")
    return kept.drop("_id")


def numbered_projects(harmonised: DataFrame, registry: str) -> DataFrame:
    """Distinct harmonised records with a ProjID and its number as ``id``.

    A record is known by a digest of its content. One that had a ProjID in an earlier run
    keeps it, whatever files have come since; new ones are numbered on from the highest.
    """
    digest = F.sha2(F.to_json(F.struct(*harmonised.columns)), 256)
    known = materialise(harmonised.distinct().withColumn("_digest", digest), "distinct")
    ids = numbering.stable_ids(known, "_digest", registry)
    number = F.substring_index("ProjID", "_", -1).cast("bigint")
    return known.join(ids, "_digest").drop("_digest").withColumn("id", number)


def resume_lookup(keys: DataFrame, landed: DataFrame, key: str, found_id, sink: str) -> DataFrame:
    """All outcomes of a lookup that only looks up what earlier runs have not.

    The keys in ``sink`` are left out and the new outcomes are added to it. Keys without
    a response yet are not written, so a later run tries them again.
    """
    table = KeyedTable(keys.sparkSession, sink, key)
    todo = table.missing(match.distinct_keys(keys, key))
    outcomes = match.lookup_doi(todo, landed, key, found_id).where(F.col("status").isNotNull())
    table.append(outcomes)
    return table.read(outcomes.schema)


def openalex_inputs(projects: DataFrame, landed: DataFrame, sink: str) -> DataFrame:
    """Number, work id and body of the projects whose DOI was found."""
    work_id = payloads.parse_json("body", "id string")["id"]
    found = resume_lookup(projects, landed, "doi", work_id, sink).where(F.col("status") == "Found")
    bodies = first_per_key(landed).select(F.col("lookup_key").alias("doi"), "body")
    numbers = projects.groupBy(text.norm_doi("doi").alias("doi")).agg(F.min("id").alias("id"))
    return match.attach_metadata(found.join(numbers, "doi"), bodies, "doi").select(
        "id", "external_id", "body"
    )


def orcid_outputs(projects: DataFrame, people: DataFrame, profiles: DataFrame, crossref: DataFrame) -> DataFrame:
    """Records of the projects whose lead is found in the directory and has a profile."""
    leads = match.resolve_pi(projects, people, "author", "id").where(F.col("orcid").isNotNull())
    parsed = profiles.select(
        "orcid",
        payloads.parse_json("record", schemas.ORCID_RECORD).alias("record"),
        payloads.parse_json("groups", f"array<{schemas.ORCID_WORKS}>").alias("groups"),
    )
    messages = crossref.select("key", payloads.parse_json("body", schemas.CROSSREF_MESSAGE).alias("msg"))
    return records.orcid_profile_records(match.attach_metadata(leads, parsed, "orcid"), messages)


def enriched(outputs: DataFrame, people: DataFrame, profiles: DataFrame, works: DataFrame) -> DataFrame:
    """Outputs with the gaps filled that the work of their DOI in their lead's profile fills.

    ``works`` has put_code and body, a work as JSON; of several bodies the smallest is taken.
    """
    numbered = materialise(outputs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    leads = match.resolve_pi(numbered.select("_row", "ProjectPI", F.col("DOI").alias("doi")), people, "ProjectPI", "_row")
    persons = profiles.select("orcid", payloads.parse_json("record", schemas.ORCID_RECORD).alias("record"))
    codes = match.work_for_doi(leads, persons, "_row").where(F.col("put_code").isNotNull()).select("_row", "put_code")
    bodies = works.where(F.col("put_code").isNotNull()).groupBy("put_code").agg(F.min("body").alias("body"))
    found = codes.join(bodies, "put_code").select("_row", payloads.parse_json("body", schemas.ORCID_WORK).alias("work"))
    return records.enrich_from_orcid_work(numbered.join(found, "_row", "left")).select(outputs.columns)


def analyse(outputs: DataFrame, works: DataFrame | None, output: str) -> None:
    """Write trends, the summary, components of the years and the keyword graph of the works."""
    topics = frequency.usable_years(outputs, "OutputYear", "OutputType")
    counts = materialise(frequency.year_topic_counts(topics), "counts")
    counts.write.mode("overwrite").parquet(f"{output}/trends")
    series = frequency.outputs_by_year(outputs, "OutputYear")
    tables.write_summary(frequency.summary_document(series), f"{output}/summary")
    # Types are a fixed list, so the matrix of years and types has a known width.
    types = sorted({*V.OUTPUT_TYPE_CODES.values(), V.OTHER_TYPE_CODE})
    present = counts.where(F.col("topic").isin(types))
    if present.select("year").distinct().limit(2).count() > 1:
        matrix = frequency.spread_counts(present, "year", "topic", types)
        lifecycle.topic_pca(matrix).write.mode("overwrite").parquet(f"{output}/components")
    if works is not None:
        keywords = payloads.parse_json("body", "title string, keywords array<string>")
        read = payloads.parsed_once(works.select("body").distinct(), "_w", keywords)
        numbered = materialise(read.select(F.monotonically_increasing_id().alias("id"), "_w.*"), "works")
        pubs = materialise(graph.publications(numbered, "id", "keywords"), "publications")
        groups = graph.components(pubs).join(communities.communities(pubs), "id").join(graph.degrees(pubs), "id")
        groups = groups.join(numbered.select("id", "title"), "id")
        groups.write.mode("overwrite").parquet(f"{output}/graph")


def run_pipeline(
    spark: SparkSession,
    landing: str,
    output: str,
    as_of_year: int,
    use_articles: bool = True,
    use_openalex: bool = True,
    related_only: bool = True,
    overlap: float | None = 0.8,
    transitive: bool = False,
) -> DataFrame:
    """From a landing folder to the table of research outputs.

    The folder holds ``group*.csv`` with project records and the Parquet tables
    ``articles``, ``openalex`` (landed responses keyed by DOI), ``core`` (author, rank,
    body), ``people`` (given, family, orcid, rank), ``profiles`` (orcid, the person's
    record and the array of its works by group, as JSON), ``crossref`` (key, body),
    ``index`` (doi, title, author, pmcid) and ``works`` (put_code, body);
    what is not there adds nothing. Projects are matched with the index by DOI, title or
    title words (``overlap``), and articles are found by DOI or by the PMC id of the match.
    Writes ``outputs``, ``lookups``, ``project_ids``, ``matches``, ``trends``, ``summary``,
    ``components`` and ``graph`` below ``output``; a second run looks up only what is new
    and changes no ProjID. Outputs are those related to the programme, unless
    ``related_only`` is off.
    """
    there = lambda name: bool(tables.list_paths(spark, f"{landing}/{name}"))
    table = lambda name, schema: spark.read.schema(schema).parquet(f"{landing}/{name}")
    frames = [harmonise.harmonise(f) for f in tables.read_group_files(spark, f"{landing}/group*.csv")]
    projects = materialise(numbered_projects(harmonise.union_complete(frames), f"{output}/project_ids"), "projects")
    by_source = {}
    works = table("core", "author string, rank bigint, body string") if there("core") else None
    if works is not None:
        by_source["CORE"] = records.core_records(projects, works, as_of_year)
    if use_articles and there("articles"):
        bodies = first_per_key(payloads.read_landed(spark, f"{landing}/articles"))
        asked = projects.select(text.norm_doi("doi").alias("lookup_key"), "id")
        if there("index"):
            listed = table("index", "doi string, title string, author string, pmcid string")
            match.match_cascade(projects, listed, "id", overlap).write.mode("overwrite").parquet(f"{output}/matches")
            matched = spark.read.parquet(f"{output}/matches").where("In_PMC")
            asked = asked.unionByName(matched.select(text.norm_doi("PMCID").alias("lookup_key"), F.col("ProjID").alias("id")))
        numbers = asked.groupBy("lookup_key").agg(F.min("id").alias("id"))
        by_source["PMC"] = records.article_records(
            match.attach_metadata(numbers, bodies, "lookup_key"), "id"
        )
    if use_openalex and there("openalex"):
        landed = payloads.read_landed(spark, f"{landing}/openalex")
        inputs = openalex_inputs(projects, landed, f"{output}/lookups")
        by_source["OpenAlex"] = records.openalex_records(inputs, "id")
    if there("people") and there("profiles"):
        people = table("people", "given string, family string, orcid string, rank bigint")
        profiles = table("profiles", "orcid string, record string, groups string")
        by_source["ORCID"] = orcid_outputs(
            projects, people, profiles,
            table("crossref", "key string, body string") if there("crossref") else spark.createDataFrame([], "key string, body string"),
        )
    combined = combine(by_source, transitive) if by_source else harmonise.conform(spark.range(0).select())
    if "ORCID" in by_source and there("works"):
        combined = enriched(combined, people, profiles, table("works", "put_code bigint, body string"))
    if related_only:
        combined = records.related_records(combined)
    combined.write.mode("overwrite").parquet(f"{output}/outputs")
    outputs = spark.read.parquet(f"{output}/outputs")
    analyse(outputs, works, output)
    return outputs
