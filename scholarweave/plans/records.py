"""Output records from landed payloads: the end-to-end plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scholarweave import schemas, vocabulary as V
from scholarweave.functions import biblio, predicates, text
from scholarweave.operators import harmonise, match
from scholarweave.sources.payloads import parse_json, parse_xml, parsed_once


def article_records(landed: DataFrame, number: str) -> DataFrame:
    """Records of the related articles among landed article XML.

    ``number`` is the column that numbers the input.
    """
    a = F.col("a")
    guarded = parsed_once(landed.select(number, "body"), "_body", biblio.guarded("body"))
    sets = parsed_once(guarded, "_set", parse_xml("_body", schemas.PMC_ARTICLESET))
    parsed = parsed_once(sets, "a", biblio.article_fields(F.col("_set"), "_body")).where(
        predicates.is_related_article(a["title"], a["abstract"])
    )
    return harmonise.conform(
        parsed.select(
            F.col(number).cast("string").alias("ProjID"),
            F.lit("Completed").alias("ProjectStatus"),
            text.project_title_or_default(a["title"]).alias("ProjectTitle"),
            a["institution"].alias("ProjectRDC"),
            a["year"].alias("ProjectYearStarted"),
            a["year"].alias("ProjectYearEnded"),
            a["first_author"].alias("ProjectPI"),
            a["title"].alias("OutputTitle"),
            biblio.full_citation(a["journal"], a["volume"], a["issue"], a["pages"]).alias("OutputBiblio"),
            biblio.type_code(a["article_type"]).alias("OutputType"),
            F.lit("PB").alias("OutputStatus"),
            text.blank_to_null(a["journal"]).alias("OutputVenue"),
            a["year"].alias("OutputYear"),
            F.substring(a["month"], 1, 2).alias("OutputMonth"),
            text.blank_to_null(a["volume"]).alias("OutputVolume"),
            text.blank_to_null(a["issue"]).alias("OutputNumber"),
            text.blank_to_null(a["pages"]).alias("OutputPages"),
        )
    )


def openalex_records(landed: DataFrame, number: str) -> DataFrame:
    """Records of the related works among landed OpenAlex JSON.

    ``landed`` has the number, the work's id URL in ``external_id`` and ``body``.
    Only rows with a proper id are parsed, and only related titles go on.
    """
    w = F.col("w")
    proper = landed.where(predicates.has_id_prefix("external_id")).select(number, "body")
    parsed = parsed_once(proper, "w", parse_json("body", schemas.OPENALEX_WORK)).where(
        predicates.is_related(w["title"])
    )
    venue = biblio.work_venue(w)
    pages = biblio.page_range_either(w["biblio"]["first_page"], w["biblio"]["last_page"])
    year = w["publication_year"].cast("string")
    return harmonise.conform(
        parsed.select(
            F.col(number).cast("string").alias("ProjID"),
            F.lit("Completed").alias("ProjectStatus"),
            text.project_title(w["title"]).alias("ProjectTitle"),
            biblio.detect_centre(w["authorships"]).alias("ProjectRDC"),
            year.alias("ProjectYearStarted"),
            year.alias("ProjectYearEnded"),
            F.get(w["authorships"], F.lit(0))["author"]["display_name"].alias("ProjectPI"),
            w["title"].alias("OutputTitle"),
            biblio.loose_citation(
                F.coalesce(venue, F.lit("Unknown")), w["biblio"]["volume"], w["biblio"]["issue"], pages
            ).alias("OutputBiblio"),
            F.nullif(biblio.type_code(w["type"], keep_unknown=True), F.lit("")).alias("OutputType"),
            F.lit("PB").alias("OutputStatus"),
            venue.alias("OutputVenue"),
            year.alias("OutputYear"),
            F.nullif(F.substring(w["publication_date"], 6, 2), F.lit("")).alias("OutputMonth"),
            w["biblio"]["volume"].alias("OutputVolume"),
            w["biblio"]["issue"].alias("OutputNumber"),
            pages.alias("OutputPages"),
        )
    )


def project_columns(as_of_year: int) -> dict[str, Column]:
    """Project part of a record built from harmonised author, title and year."""
    start = text.clean_year("year")
    end = biblio.end_year(start)
    return {
        "ProjectStatus": biblio.project_status(start, end, as_of_year),
        "ProjectTitle": text.strip(F.coalesce("title", F.lit(V.UNTITLED_PROJECT))),
        "ProjectYearStarted": start,
        "ProjectYearEnded": end,
        "ProjectPI": text.strip(F.coalesce("author", F.lit(V.UNKNOWN_PI))),
    }


def core_records(
    projects: DataFrame, works: DataFrame, as_of_year: int, candidates: int | None = None
) -> DataFrame:
    """One record per project, with the best of the works found under its lead's name.

    ``projects`` has id, ProjID, author, title and year; ``works`` has author,
    rank and ``body``, a landed search hit.
    """
    described = projects.withColumns(project_columns(as_of_year)).withColumn(
        "author", F.when(predicates.is_known_pi("author"), text.strip("author"))
    )
    found = match.best_work(
        described, works, parse_json("body", schemas.CORE_WORK), candidates
    )
    w = F.col("work")
    return harmonise.conform(
        found.select(
            "ProjID", "ProjectStatus", "ProjectTitle",
            F.when(w.isNotNull(), biblio.infer_centre(w["institutions"])).alias("ProjectRDC"),
            "ProjectYearStarted", "ProjectYearEnded", "ProjectPI",
            w["title"].alias("OutputTitle"),
            biblio.doi_reference(w["doi"], "DOI: ").alias("OutputBiblio"),
            F.when(w.isNotNull(), biblio.type_guess(w["documentType"])).alias("OutputType"),
            F.when(w.isNotNull(), "Published").alias("OutputStatus"),
            w["publisher"].alias("OutputVenue"),
            text.date_year(w["publishedDate"]).alias("OutputYear"),
            text.date_month(w["publishedDate"]).alias("OutputMonth"),
            w["volume"].alias("OutputVolume"),
            w["issue"].alias("OutputNumber"),
            w["pages"].alias("OutputPages"),
            w["doi"].alias("DOI"),
            F.lit("CORE").alias("Source"),
        )
    )


def orcid_records(persons: DataFrame, as_of_year: int) -> DataFrame:
    """One record per project from its lead's ORCID record.

    ``persons`` has ProjID, author, title, year, the parsed person struct
    ``record`` and ``works``, the parsed works in listed order.
    """
    w = F.col("_work")
    employments = F.col("record")["activities-summary"]["employments"]["employment-summary"]
    ids = w["external-ids"]["external-id"]
    date = w["publication-date"]
    cite = biblio.citation_labelled(w["citation"]["citation-value"], w["citation"]["citation-type"])
    known = predicates.is_known_pi("author")
    chosen = persons.withColumn(
        "_work", F.when(known, match.relevant_work("works", "title"))
    )
    return harmonise.conform(
        chosen.withColumns(project_columns(as_of_year)).select(
            "ProjID", "ProjectStatus", "ProjectTitle",
            F.when(known, biblio.latest_employment(employments)).alias("ProjectRDC"),
            "ProjectYearStarted", "ProjectYearEnded", "ProjectPI",
            w["title"]["title"]["value"].alias("OutputTitle"),
            biblio.doi_reference(biblio.first_external_id(ids)).alias("OutputBiblio"),
            w["type"].alias("OutputType"),
            F.when(w.isNotNull(), F.when(date.isNotNull(), "Published").otherwise("Unpublished"))
            .alias("OutputStatus"),
            biblio.journal_or_issn(w).alias("OutputVenue"),
            date["year"]["value"].alias("OutputYear"),
            date["month"]["value"].alias("OutputMonth"),
            cite["volume"].alias("OutputVolume"),
            cite["number"].alias("OutputNumber"),
            cite["pages"].alias("OutputPages"),
            biblio.first_external_id(ids).alias("DOI"),
        )
    )


PROFILE_COLUMNS = [c for c in schemas.OUTPUT_COLUMNS if c != "Source"]


def orcid_profile_records(persons: DataFrame, messages: DataFrame) -> DataFrame:
    """One record of 18 columns per project lead with a titled work.

    The lead's employment history gives the project's years and centre, the first titled
    work of the groups the output, and the CrossRef message of its DOI the venue and the
    bibliography. ``persons`` has ProjID, author, title, the parsed struct ``record`` and
    ``groups``, the parsed works by group; ``messages`` has key and the parsed ``msg``.
    Leads without a full name and those without a titled work give no record.
    """
    w, job = F.col("_work"), F.col("_job")
    employments = F.col("record")["activities-summary"]["employments"]["employment-summary"]
    ids, date = w["external-ids"]["external-id"], w["publication-date"]
    chosen = (
        persons.where(predicates.is_valid_pi("author"))
        .select("ProjID", "author", "title", match.first_grouped_work("groups").alias("_work"),
                biblio.first_employment(employments).alias("_job"))
        .where(w.isNotNull())
    )
    found = chosen.select(
        "ProjID",
        biblio.status_from_end(job["ended"]).alias("ProjectStatus"),
        F.col("title").alias("ProjectTitle"),
        job["organisation"].alias("ProjectRDC"),
        job["started"].alias("ProjectYearStarted"),
        job["ended"].alias("ProjectYearEnded"),
        F.col("author").alias("ProjectPI"),
        w["title"]["title"]["value"].alias("OutputTitle"),
        biblio.type_label(w["type"]).alias("OutputType"),
        biblio.output_status(date["year"]["value"]).alias("OutputStatus"),
        date["year"]["value"].alias("OutputYear"),
        date["month"]["value"].alias("_month"),
        biblio.first_external_id(ids).alias("DOI"),
    )
    full = match.attach_crossref(found, messages, "DOI", "ProjID")
    return full.withColumn("OutputMonth", F.coalesce("OutputMonth", "_month")).select(PROFILE_COLUMNS)


def enrich_from_orcid_work(rows: DataFrame) -> DataFrame:
    """Fill volume, number, pages, month and venue from the work a row's DOI names.

    ``rows`` has the output columns and the parsed struct ``work`` (null if none).
    The compact citation replaces values where it is present; the dated one and
    the month only fill gaps. Rows that already have venue and volume keep both.
    """
    w = F.col("work")
    citation = w["citation"]["citation-value"]
    done = predicates.already_enriched(["OutputVenue", "OutputVolume"])
    full = F.col("OutputVolume").isNotNull() & F.col("OutputNumber").isNotNull() & F.col("OutputPages").isNotNull()
    # The searches are dear: the first is made only where it may replace something, the
    # second only where there is a gap.
    parsed = rows.withColumns(
        {
            "_compact": F.when(~done, biblio.citation_compact(citation)),
            "_dated": F.when(~full, biblio.citation_dated(citation)),
        }
    )

    def update(name: str, field: str) -> Column:
        current = F.col(name)
        replaced = F.when(done, current).otherwise(F.coalesce(f"_compact.{field}", current))
        return F.coalesce(replaced, f"_dated.{field}")

    return parsed.withColumns(
        {
            "OutputVenue": F.when(done, F.col("OutputVenue")).otherwise(
                text.override("OutputVenue", w["journal-title"]["value"])
            ),
            "OutputVolume": update("OutputVolume", "volume"),
            "OutputNumber": update("OutputNumber", "number"),
            "OutputPages": update("OutputPages", "pages"),
            "OutputMonth": text.fill_if_null("OutputMonth", date_month_of(w)),
        }
    ).drop("_compact", "_dated")


def date_month_of(work: Column) -> Column:
    return F.nullif(work["publication-date"]["month"]["value"], F.lit(""))


def related_records(df: DataFrame) -> DataFrame:
    """Programme-related records with standard centre names."""
    fields = ["ProjectRDC", "ProjectTitle", "OutputTitle", "OutputVenue", "OutputBiblio", "ProjectPI"]
    return df.where(predicates.is_related_record(fields)).withColumn(
        "ProjectRDC", biblio.standard_centre("ProjectRDC")
    )
