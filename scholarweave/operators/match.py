"""Matching records against other tables and against landed payloads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from scholarweave.functions import biblio
from scholarweave.functions.predicates import is_present, is_related_work, is_valid_pi
from scholarweave.functions.text import (
    ColumnOrName, blank_to_null, col, first_author, first_token, last_token, norm_doi, norm_words, once,
)
from scholarweave.operators import title_search
from scholarweave.operators.ordered import limit_per_key
from scholarweave.sources.payloads import first_per_key, parsed_once
from scholarweave.workspace import materialise


def spread_nulls(key: Column, unique: ColumnOrName) -> Column:
    """Replace null join keys by values that match nothing and hash apart.

    An outer join would otherwise send every row without a key to one task.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), col(unique).cast("string")))


def attach(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left outer join on differently named keys.

    No broadcast hint: Spark sends the right side to every task only when it
    knows it to be below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return left.join(right, left[left_key] == right[right_key], "left")


def fill_from(
    left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Left join on ``on``; nulls in ``columns`` are filled from the right side."""
    suffixed = right.select(*on, *[F.col(c).alias(f"{c}_right") for c in columns])
    joined = left.join(suffixed, list(on), "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"{c}_right")) for c in columns}
    return joined.withColumns(filled).drop(*[f"{c}_right" for c in columns]).select(left.columns)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(norm_doi(key).alias(key)).na.drop().distinct()


def pending(keys: DataFrame, done: DataFrame | None, key: str) -> DataFrame:
    """Normalised keys that are not among the processed ones."""
    todo = distinct_keys(keys, key)
    if done is None:
        return todo
    return todo.join(distinct_keys(done, key), key, "left_anti")


def lookup_doi(
    keys: DataFrame, landed: DataFrame, key: str, found_id: Column, well_formed: Column | None = None
) -> DataFrame:
    """Status and external id of every key, from the landed responses.

    ``found_id`` reads the id out of the column ``body``; ``well_formed`` says whether
    the body can be read at all, by default whether it is JSON. Of several responses
    for a key one with an id is taken, else one that says there is none.
    """
    todo = distinct_keys(keys, key)
    if well_formed is None:
        well_formed = F.try_parse_json("body").isNotNull()
    told = landed.withColumn("well_formed", F.coalesce(well_formed, F.lit(False))).withColumn(
        "external_id", F.when((F.col("code") == 200) & F.col("error").isNull(), blank_to_null(found_id))
    )
    hit = F.col("external_id").isNotNull()
    absent = ((F.col("code") == 200) & F.col("well_formed")) | (F.col("code") == 404)
    rank = F.when(hit, 0).when(absent & F.col("error").isNull(), 1).otherwise(2)
    answers = first_per_key(told, rank=rank)
    joined = todo.join(answers, todo[key] == answers["lookup_key"], "left")
    status = F.when(
        F.col("lookup_key").isNotNull(), biblio.lookup_status("code", hit, "error", "well_formed")
    )
    return joined.select(
        key, status.alias("status"), F.when(F.col("code") == 200, F.col("external_id")).alias("external_id")
    )


def match_cascade(
    records: DataFrame, index: DataFrame, id_column: str = "id", overlap: float | None = None
) -> DataFrame:
    """Find each record in an index by DOI, else by title and first author.

    With ``overlap`` those found by neither are looked up a third time, by the words of their
    title: the first author's titles count that have at least that part of the words in common.

    ``records`` has id, title, author and doi; ``index`` has doi, title, author
    and pmcid. Both index lookups are made unique by partial aggregation first,
    so the joins cannot multiply rows. They are stored, so that Spark knows their sizes:
    small ones go to every task and the records, with their long titles, stay where
    they are; otherwise the records are shuffled. The second key is computed only for
    records that are not found by DOI.
    """
    title = F.col("title")
    author = first_author("author")

    # Null keys are dropped from what is stored: Spark would compute the keys again for a filter before.
    doi_answers = index.groupBy(norm_doi("doi").alias("_doi")).agg(F.min("pmcid").alias("_pmcid_doi"))
    by_doi = materialise(doi_answers, "by-doi").where(F.col("_doi").isNotNull())
    index_key = _title_author_key(title, author)
    title_answers = index.groupBy(index_key.alias("_pair")).agg(F.min("pmcid").alias("_pmcid_pair"))
    by_title = materialise(title_answers, "by-title").where(F.col("_pair").isNotNull())

    prepared = records.withColumns(
        {
            "Title": title,
            "Author": author,
            "_doi": spread_nulls(norm_doi("doi"), id_column),
        }
    )
    first = prepared.join(by_doi, "_doi", "left")
    pair = F.when(F.col("_pmcid_doi").isNull(), _title_author_key(title, F.col("Author")))
    second = first.withColumn("_pair", spread_nulls(pair, id_column)).join(
        by_title, "_pair", "left"
    )
    found_doi = F.col("_pmcid_doi").isNotNull()
    found_pair = F.col("_pmcid_pair").isNotNull()
    if overlap is None:
        second = second.withColumn("_pmcid_words", F.lit(None).cast("string"))
    else:
        missed = materialise(second.where(~found_doi & ~found_pair).select(id_column, "title", "author"), "missed")
        near = title_search.with_match(missed, index.select("title", "author", "pmcid"), author, "pmcid", overlap)
        second = second.join(near.select(id_column, F.col("pmcid").alias("_pmcid_words")), id_column, "left")
    found_words = F.col("_pmcid_words").isNotNull()
    complete = is_present("Title") & F.col("Author").isNotNull()
    return second.select(
        F.col(id_column).alias("ProjID"),
        "Title",
        "Author",
        F.col("doi").alias("DOI"),
        (found_doi | found_pair | found_words).alias("In_PMC"),
        F.coalesce("_pmcid_doi", "_pmcid_pair", "_pmcid_words").alias("PMCID"),
        F.when(found_doi, "DOI").when(found_pair, "Title/Author").when(found_words, "Title words").alias("Method"),
        F.when(found_doi, "Found by DOI")
        .when(found_pair, "Found by title/author")
        .when(found_words, "Found by title words")
        .when(complete, "Not found in PMC")
        .otherwise("Missing title or author").alias("Reason"),
    )


def _title_author_key(title: Column, author: Column) -> Column:
    """Digest of both parts; null unless both are there. A title without an author is not read."""
    digest = lambda a: F.when(a.isNotNull(), F.sha2(F.concat(norm_words(title), F.lit("\n"), a), 256))
    return once(F.lower(author), digest)


def attach_metadata(ids: DataFrame, articles: DataFrame, on: str) -> DataFrame:
    """Keep the ids for which metadata was landed."""
    return ids.join(articles, on, "inner")


def attach_crossref(records: DataFrame, messages: DataFrame, doi: str, unique: str) -> DataFrame:
    """Venue, volume, number, pages, month and bibliography from the message of a DOI.

    ``messages`` has one row per landed message: key and the parsed struct ``msg``.
    Of several messages for a DOI the one with the fewest gaps is taken.
    """
    msg = F.col("msg")
    details = messages.select(
        norm_doi("key").alias("_doi"),
        F.struct(
            F.get(msg["container-title"], F.lit(0)).alias("OutputVenue"),
            msg["volume"].alias("OutputVolume"),
            msg["issue"].alias("OutputNumber"),
            msg["page"].alias("OutputPages"),
            biblio.printed_month(msg).cast("string").alias("OutputMonth"),
            biblio.crossref_biblio(msg).alias("OutputBiblio"),
        ).alias("_cr"),
    )
    names = details.schema["_cr"].dataType.names
    gaps = reduce(Column.__add__, [F.col("_cr")[n].isNull().cast("int") for n in names])
    best = F.min_by("_cr", F.struct(gaps, "_cr"))
    unique_details = (
        details.where(F.col("_doi").isNotNull()).groupBy("_doi").agg(best.alias("_cr"))
    )
    keyed = records.withColumn("_doi", spread_nulls(norm_doi(doi), unique))
    return keyed.join(unique_details, "_doi", "left").drop("_doi").select("*", "_cr.*").drop("_cr")


# Titles of one author that are compared with all works of that author.
TITLES_PAIRED = 64

WORK_FIELDS = (
    "title", "institutions", "documentType", "publisher", "publishedDate", "doi", "volume", "issue", "pages",
)


def best_work(
    projects: DataFrame,
    works: DataFrame,
    work: ColumnOrName = "work",
    candidates: int | None = None,
    related=is_related_work,
    fields: Sequence[str] = WORK_FIELDS,
) -> DataFrame:
    """The work kept for each project, searched by the author's name.

    ``projects`` has id, author and title; ``works`` has author, rank and what
    ``work`` makes a work struct of. Of an author's related works, the first whose
    title contains the project title wins, else the first; equal ranks are told
    apart by the work itself. ``candidates`` limits the search to so many works of
    an author, related or not, as a search that returns one page would.

    Relatedness is decided where a work is read, and only ``fields`` go on; they are stored,
    so that a work is parsed once for both searches. The first work of an author, and the first that fits a title, are partial
    aggregates, so no list of works is ever gathered. Works and titles of one author meet
    all with all only as long as the titles are few; those of an author with more of them
    meet by a part that the work's title has to share (:func:`title_probe`).
    """
    listed = works.where(F.col("author").isNotNull())
    if candidates is not None:
        listed = limit_per_key(listed, "author", ["rank", F.xxhash64(*works.columns)], candidates)
    read = parsed_once(listed.select("author", "rank", col(work).alias("_in")), "_w", F.col("_in"))
    kept = F.struct("rank", F.struct(*[F.col("_w")[f].alias(f) for f in fields]).alias("work")).alias("_work")
    slim = materialise(read.where(related(F.col("_w"))).select(F.col("author").alias("_author"), kept), "related-works")
    wanted = projects.select(F.col("author").alias("_author"), F.lower("title").alias("_title")).na.drop().distinct()
    busy = wanted.groupBy("_author").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > TITLES_PAIRED)
    busy = materialise(busy.select("_author", F.lit(True).alias("_busy")), "busy-authors")
    listed_title = F.lower(F.col("_work")["work"]["title"])
    met = lambda probes: F.explode(F.when(F.col("_busy"), probes).otherwise(F.array(F.lit("")))).alias("_probe")
    left = slim.join(busy, "_author", "left").select("_author", "_work", met(_probed(listed_title)))
    right = wanted.join(busy, "_author", "left").select("_author", "_title", met(F.array(title_probe("_title"))))
    fits = F.contains(listed_title, F.col("_title"))
    by_title = left.join(right, ["_author", "_probe"]).where(fits).groupBy("_author", "_title").agg(F.min("_work").alias("_fit"))
    by_author = slim.groupBy("_author").agg(F.min("_work").alias("_first"))
    joined = (
        projects.withColumn("_author", spread_nulls(F.col("author"), "id"))
        .withColumn("_title", F.lower("title"))
        .join(by_author, "_author", "left")
        .join(by_title, ["_author", "_title"], "left")
    )
    return joined.select(*projects.columns, F.coalesce("_fit", "_first")["work"].alias("work"))


def _split_words(title: Column) -> Column:
    return F.split(title, r"[^\p{L}\p{N}]+")


def title_probe(title: ColumnOrName) -> Column:
    """A part of a title that every text holding the title has among its :func:`_probed`.

    That is its longest word that has other words on both sides, because these words are
    whole words of the text as well; without one its first three characters.
    """
    words = _split_words(col(title))
    inner = F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))
    longest = F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    return F.coalesce(F.nullif(longest, F.lit("")), F.when(F.length(col(title)) >= 3, F.substring(col(title), 1, 3)), F.lit(""))


def _probed(title: Column) -> Column:
    """All words of a text, its parts of three characters, and the empty part."""
    threes = F.transform(F.sequence(F.lit(1), F.greatest(F.length(title) - 2, F.lit(1))), lambda i: F.substring(title, i, F.lit(3)))
    return F.array_distinct(F.concat(_split_words(title), threes, F.array(F.lit(""))))


def relevant_work(works: ColumnOrName, title: ColumnOrName) -> Column:
    """From a person's works: the last whose title contains the project title, else the first.

    A match at the first place only counts if no later work matches, which is the
    same as taking the last match.
    """
    wanted = F.lower(col(title))
    matching = F.filter(
        col(works), lambda w: F.contains(F.lower(w["title"]["title"]["value"]), wanted)
    )
    return F.coalesce(
        F.try_element_at(matching, F.lit(-1)), F.try_element_at(col(works), F.lit(1))
    )


def first_titled_work(works: ColumnOrName) -> Column:
    titled = F.filter(col(works), lambda w: w["title"].isNotNull())
    return F.try_element_at(titled, F.lit(1))


def first_grouped_work(groups: ColumnOrName, limit: int | None = None) -> Column:
    """First titled work among the leading works of the groups, or of the first ``limit``."""
    some = col(groups) if limit is None else F.slice(col(groups), 1, limit)
    return first_titled_work(F.transform(some, lambda g: F.get(g, F.lit(0))))


def resolve_pi(projects: DataFrame, people: DataFrame, name: str, unique: str) -> DataFrame:
    """ORCID of a name: by given and family name, else by family name alone.

    ``people`` has given, family, orcid and rank (lower comes first in the search).
    Both lookups are reduced to one row per key before joining. A name of one word
    says too little: it meets nobody.
    """
    first = F.min_by("orcid", F.struct("rank", "orcid"))
    full_key = F.lower(F.concat(F.col("given"), F.lit("\n"), F.col("family")))
    by_full = people.groupBy(full_key.alias("_full")).agg(first.alias("_orcid_full"))
    by_family = people.groupBy(F.lower("family").alias("_family")).agg(
        first.alias("_orcid_family")
    )
    valid = is_valid_pi(name)
    given = F.when(valid, F.lower(first_token(name)))
    family = F.when(valid, F.lower(last_token(name)))
    full = spread_nulls(F.concat(given, F.lit("\n"), family), unique)
    step = projects.withColumn("_full", full).join(
        by_full.where(F.col("_full").isNotNull()), "_full", "left"
    )
    missed = F.when(F.col("_orcid_full").isNull(), family)
    step = step.withColumn("_family", spread_nulls(missed, unique)).join(
        by_family.where(F.col("_family").isNotNull()), "_family", "left"
    )
    return step.select(
        *projects.columns, F.coalesce("_orcid_full", "_orcid_family").alias("orcid")
    )


def works_by_doi(persons: DataFrame) -> DataFrame:
    """(orcid, doi) -> first put-code, from nested person records.

    ``persons`` has orcid and the parsed struct ``record``. Positions give the
    order groups, summaries and ids were listed in.
    """
    groups = F.col("record")["activities-summary"]["works"]["group"]
    exploded = (
        persons.select("orcid", F.posexplode(groups).alias("_g", "_group"))
        .select("orcid", "_g", F.posexplode(F.col("_group")["work-summary"]).alias("_s", "_sum"))
        .select(
            "orcid", "_g", "_s", F.col("_sum")["put-code"].alias("put_code"),
            F.explode(F.col("_sum")["external-ids"]["external-id"]).alias("_id"),
        )
        .where(F.lower(F.col("_id")["external-id-type"]) == "doi")
    )
    doi = norm_doi(F.col("_id")["external-id-value"])
    return (
        exploded.groupBy("orcid", doi.alias("doi"))
        .agg(F.min_by("put_code", F.struct("_g", "_s")).alias("put_code"))
        .where(F.col("doi").isNotNull())
    )


def work_for_doi(rows: DataFrame, persons: DataFrame, unique: str) -> DataFrame:
    """Attach the put-code of the work a row's DOI names in its person's record."""
    lookup = works_by_doi(persons).withColumnsRenamed({"orcid": "_orcid", "doi": "_doi"})
    keyed = rows.withColumn("_orcid", F.col("orcid")).withColumn(
        "_doi", spread_nulls(norm_doi("doi"), unique)
    )
    return keyed.join(lookup, ["_orcid", "_doi"], "left").select(*rows.columns, "put_code")
