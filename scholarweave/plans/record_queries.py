"""Output records from landed payloads that Spark derives from the driver tables.

Each document stands for a work, an article or a person: its first line is the
title, its lines are the paragraphs of the article or the works of the person.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scholarweave import schemas, vocabulary as V
from scholarweave.functions import biblio, predicates
from scholarweave.operators import match
from scholarweave.plans import pipeline, records
from scholarweave.plans.registry import query
from scholarweave.plans.text_queries import (
    CITATION_SQL, TITLE_PATTERN_SQL, citations, sql_case, sql_contains, sql_lookup,
)
from scholarweave.sources.payloads import parse_json, parse_xml

TITLE_SQL = "string_split(text, chr(10))[1]"


def title_line():
    return F.get(F.split("text", "\n"), F.lit(0))


@query(
    "json_payload",
    """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
  CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k_if_whole
FROM events
""",
)
def json_payload(t):
    cut = F.when(F.col("event_type") == "error", F.left("props", F.lit(4))).otherwise(F.col("props"))
    return t.events.select(
        "event_id",
        parse_json("props", "k int")["k"].alias("k"),
        parse_json(cut, "k int")["k"].alias("k_if_whole"),
    )


@query(
    "search_payload",
    """
SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('5-LOW', '1-URGENT') THEN CAST(o_custkey AS VARCHAR) END AS pmcid FROM orders
""",
)
def search_payload(t):
    p = F.col("o_orderpriority")
    ids = F.concat(F.lit("<IdList><Id>"), "o_custkey", F.lit("</Id><Id>0</Id></IdList>"))
    body = (
        F.when(p == "5-LOW", "<eSearchResult><Count>0</Count><IdList/></eSearchResult>")
        .when(p == "1-URGENT", F.concat(F.lit("<eSearchResult><Count>2</Count>"), ids))
        .otherwise(F.concat(F.lit("<eSearchResult><Count>2</Count>"), ids, F.lit("</eSearchResult>")))
    )
    result = parse_xml(body, schemas.ESEARCH_RESULT)
    return t.orders.select("o_orderkey", biblio.search_hit(result).alias("pmcid"))


def _xml_escape(c):
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def landed_articles(t):
    """Documents as article XML in the forms that articles come in.

    By length the abstract is plain, in sections inside each other, one of two, or its
    paragraphs stand in a list, a box or a quotation, the author stands in the second
    group of contributors or has a labelled affiliation, or another article follows.
    Titles have inline tags and escaped brackets. Spanish ones are cut off before the end.
    """
    form = F.col("n_chars") % 10
    around = lambda before, every, behind: F.concat(F.lit(f"<abstract>{before}"), every, F.lit(f"{behind}</abstract>"))
    paragraphs = F.transform(F.split("text", "\n"), lambda p: F.concat(F.lit("<p>"), _xml_escape(p), F.lit("</p>")))
    every = F.array_join(paragraphs, "")
    abstract = (
        F.when(form == 1, F.concat(F.lit("<abstract><sec><title>Aim</title><sec>"), every, F.lit("</sec></sec></abstract>")))
        .when(
            form == 2,
            F.concat(
                F.lit("<abstract>"), F.get(paragraphs, F.lit(0)), F.lit("</abstract><abstract abstract-type=\"summary\">"),
                F.array_join(F.slice(paragraphs, 2, F.greatest(F.size(paragraphs), F.lit(1))), ""), F.lit("</abstract>"),
            ),
        )
        .when(form == 6, around("<sec><title>Aim</title>" + "<sec>" * 4, every, "</sec>" * 5))
        .when(form == 7, around("<list>", F.array_join(F.transform(paragraphs, lambda p: F.concat(F.lit("<list-item>"), p, F.lit("</list-item>"))), ""), "</list>"))
        .when(form == 8, around("<boxed-text><label>1</label>", F.replace(F.replace(every, F.lit("<p>"), F.lit("<p content-type='a'><b>")), F.lit("</p>"), F.lit("</b></p>")), "</boxed-text>"))
        .when(form == 9, around("<p>Said: <disp-quote>", every, "</disp-quote></p>"))
        .otherwise(around("", every, ""))
    )
    place = F.when(form == 4, F.concat(F.lit("<aff><label>1</label>Univ <b>"), F.col("source"), F.lit("</b></aff>"))).otherwise("")
    body = F.concat(
        F.lit("<pmc-articleset><article article-type=\"Journal-Article\"><front><journal-meta><journal-title-group><journal-title>"),
        F.lit("Annals of "), F.col("source"),
        F.lit("</journal-title></journal-title-group></journal-meta><article-meta><title-group><article-title><i>On</i> "),
        _xml_escape(title_line()),
        F.lit(" p &lt;x and y&gt; z</article-title></title-group><contrib-group><contrib contrib-type=\"editor\"><name><surname>Ed</surname></name></contrib>"),
        F.when(form == 3, "</contrib-group><contrib-group>").otherwise(""),
        F.lit("<contrib contrib-type=\"author\"><name><surname>"), F.col("lang"),
        F.lit("</surname><given-names>Ann</given-names></name>"), place, F.lit("</contrib></contrib-group>"),
        F.lit("<pub-date date-type=\"pub\"><year>"), F.col("n_chars") % 40 + 1980,
        F.lit("</year><month>11</month></pub-date><volume>"), F.col("doc_id"),
        F.lit("</volume>"), F.when(F.col("n_chars") % 2 == 0, "<issue>3</issue>").otherwise(""),
        F.lit("<fpage>1</fpage><lpage>"), F.col("n_chars"), F.lit("</lpage>"), abstract,
        F.lit("</article-meta></front></article>"),
        F.when(form == 5, "<article article-type=\"other\"><front><article-meta><title-group><article-title>Second</article-title>"
               "</title-group></article-meta></front></article>").otherwise(""),
        F.when(F.col("lang") != "es", "</pmc-articleset>").otherwise(""),
    )
    return t.documents.select("doc_id", body.alias("body"))


_ARTICLE_SQL = f"""
WITH d AS (SELECT *, 'On ' || {TITLE_SQL} || ' p <x and y> z' AS title, replace(text, chr(10), ' ') AS abstract,
  CAST(n_chars % 40 + 1980 AS VARCHAR) AS y FROM documents WHERE lang <> 'es')
SELECT CAST(doc_id AS VARCHAR) AS "ProjID", 'Completed' AS "ProjectStatus",
  CASE WHEN contains(lower(title), 'fsrdc') THEN title ELSE 'FSRDC Project' END AS "ProjectTitle",
  CASE WHEN n_chars % 10 = 4 THEN 'Univ ' || source END AS "ProjectRDC", y AS "ProjectYearStarted", y AS "ProjectYearEnded", 'Ann ' || lang AS "ProjectPI",
  title AS "OutputTitle",
  CASE WHEN n_chars % 2 = 0 THEN 'Annals of ' || source || ', Vol ' || doc_id || ', Iss 3, pp. 1-' || n_chars END AS "OutputBiblio",
  'JA' AS "OutputType", 'PB' AS "OutputStatus", 'Annals of ' || source AS "OutputVenue", y AS "OutputYear", '11' AS "OutputMonth",
  CAST(doc_id AS VARCHAR) AS "OutputVolume", CASE WHEN n_chars % 2 = 0 THEN '3' END AS "OutputNumber", '1-' || n_chars AS "OutputPages",
  CAST(NULL AS VARCHAR) AS "DOI", CAST(NULL AS VARCHAR) AS "Source"
FROM d WHERE {sql_contains('title', V.RELATED_KEYWORDS)} OR {sql_contains('abstract', V.RELATED_KEYWORDS)}
"""


@query("article_records", _ARTICLE_SQL)
def article_records(t):
    return records.article_records(landed_articles(t), "doc_id")


WORK_KINDS = {"en": "journal-article", "de": "Book-Chapter", "fr": "dataset", "es": "preprint"}


def landed_openalex(t):
    """Documents as OpenAlex works; some ids are of another kind."""
    kind = F.create_map(*[F.lit(x) for pair in WORK_KINDS.items() for x in pair])[F.col("lang")]
    year = F.col("n_chars") % 40 + 1980
    place = "struct<display_name:string>"
    body = F.to_json(
        F.struct(
            F.concat(F.lit("https://openalex.org/W"), "doc_id").alias("id"),
            title_line().alias("title"),
            year.alias("publication_year"),
            F.concat(year, F.lit("-05-01")).alias("publication_date"),
            kind.alias("type"),
            F.when(F.col("lang") != "fr", F.struct(F.when(F.col("lang") == "en", F.col("source")).otherwise("").alias("display_name"))).alias("host_venue"),
            F.struct(F.struct(F.concat(F.lit("Press "), "source").alias("display_name")).alias("source")).alias("primary_location"),
            F.struct(
                F.col("doc_id").cast("string").alias("volume"),
                F.when(F.col("n_chars") % 2 == 0, "9").alias("issue"),
                F.when(F.col("n_chars") % 3 != 0, F.col("n_chars").cast("string")).alias("first_page"),
                (F.col("n_chars") + 5).cast("string").alias("last_page"),
            ).alias("biblio"),
            F.array(
                F.struct(F.struct(F.concat(F.lit("Dr "), "lang").alias("display_name")).alias("author"),
                         F.array().cast(f"array<{place}>").alias("institutions")),
                F.struct(F.struct(F.lit("Second").alias("display_name")).alias("author"),
                         F.array(F.struct(F.lit("A College").alias("display_name")),
                                 F.struct(F.concat("source", F.lit(" rdc")).alias("display_name"))).alias("institutions")),
            ).alias("authorships"),
        )
    )
    prefix = F.when(F.col("source") != "src3", "https://openalex.org/W").otherwise("http://other/")
    return t.documents.select("doc_id", F.concat(prefix, "doc_id").alias("external_id"), body.alias("body"))


_OPENALEX_SQL = f"""
WITH d AS (SELECT *, {TITLE_SQL} AS title, CAST(n_chars % 40 + 1980 AS VARCHAR) AS y,
  CASE lang {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in WORK_KINDS.items())} END AS kind,
  CASE WHEN lang = 'en' THEN source ELSE 'Press ' || source END AS venue,
  CASE WHEN n_chars % 2 = 0 THEN '9' END AS issue,
  CASE WHEN n_chars % 3 <> 0 THEN n_chars || '-' ELSE '' END || (n_chars + 5) AS pages
  FROM documents WHERE source <> 'src3')
SELECT CAST(doc_id AS VARCHAR) AS "ProjID", 'Completed' AS "ProjectStatus",
  CASE WHEN regexp_matches(title, '{TITLE_PATTERN_SQL}') THEN trim(regexp_extract(title, '{TITLE_PATTERN_SQL}', 2)) ELSE substr(title, 1, 100) END AS "ProjectTitle",
  source || ' rdc' AS "ProjectRDC", y AS "ProjectYearStarted", y AS "ProjectYearEnded", 'Dr ' || lang AS "ProjectPI",
  title AS "OutputTitle", venue || ', Vol ' || doc_id || ', Iss ' || coalesce(issue, '') || ', pp. ' || pages AS "OutputBiblio",
  {sql_lookup('kind', V.OUTPUT_TYPE_CODES, 'upper(kind)')} AS "OutputType", 'PB' AS "OutputStatus", venue AS "OutputVenue",
  y AS "OutputYear", '05' AS "OutputMonth", CAST(doc_id AS VARCHAR) AS "OutputVolume", issue AS "OutputNumber", pages AS "OutputPages",
  CAST(NULL AS VARCHAR) AS "DOI", CAST(NULL AS VARCHAR) AS "Source"
FROM d WHERE {sql_contains('title', V.RELATED_KEYWORDS)}
"""


@query("openalex_records", _OPENALEX_SQL)
def openalex_records(t):
    return records.openalex_records(landed_openalex(t), "doc_id")


def core_projects(t):
    """Customers as projects, searched under the name of their document source."""
    nation = F.col("c_nationkey")
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("PROJ_"), "c_custkey").alias("ProjID"),
        F.when(nation < 22, F.concat(F.lit("src"), nation)).when(nation == 22, "Unknown PI").alias("author"),
        F.lower(F.left("c_mktsegment", F.lit(2))).alias("title"),
        F.when(nation != 4, (nation + 1985).cast("string")).otherwise("soon").alias("year"),
    )


def landed_core(t):
    """Documents as search hits listed under their source, newest id first."""
    body = F.to_json(
        F.struct(
            title_line().alias("title"),
            F.col("text").alias("fullText"),
            F.array("lang", "source").alias("keywords"),
            F.array(F.struct(F.when(F.col("lang") == "fr", "Univ. of TEXAS").otherwise("Elsewhere").alias("name"))).alias("institutions"),
            F.when(F.col("lang") == "en", "Journal piece").when(F.col("lang") == "de", "PhD thesis").otherwise("talk").alias("documentType"),
            F.concat(F.lit("Press "), "source").alias("publisher"),
            F.concat(F.col("n_chars") % 40 + 1980, F.lit("-06-30")).alias("publishedDate"),
            F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit("10.8/"), "doc_id")).alias("doi"),
            F.col("doc_id").cast("string").alias("volume"),
            F.lit("2").alias("issue"),
        )
    )
    return t.documents.select(F.col("source").alias("author"), (-F.col("doc_id")).alias("rank"), body.alias("body"))


_CORE_SQL = f"""
WITH p AS (SELECT c_custkey AS id, 'PROJ_' || c_custkey AS proj_id,
  CASE WHEN c_nationkey < 22 THEN 'src' || c_nationkey WHEN c_nationkey = 22 THEN 'Unknown PI' END AS author,
  lower(left(c_mktsegment, 2)) AS title, CASE WHEN c_nationkey <> 4 THEN c_nationkey + 1985 END AS s FROM customer),
w AS (SELECT *, {TITLE_SQL} AS wtitle, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS place FROM documents),
r AS (SELECT * FROM w WHERE {sql_contains("concat_ws(' ', nullif(wtitle, ''), nullif(text, ''), lang, source, CASE WHEN lang = 'fr' THEN 'Univ. of TEXAS' ELSE 'Elsewhere' END)", V.RELATED_KEYWORDS_LONG)}),
b AS (SELECT p.*, r.*, row_number() OVER (PARTITION BY p.id ORDER BY contains(lower(wtitle), title) DESC, place) AS pick
  FROM p LEFT JOIN r ON p.author = r.source)
SELECT proj_id AS "ProjID", CASE WHEN s IS NULL THEN 'Unknown' WHEN s + 3 < 1999 THEN 'Completed' WHEN s <= 1999 THEN 'Active' ELSE 'Planned' END AS "ProjectStatus",
  title AS "ProjectTitle", CASE WHEN doc_id IS NULL THEN NULL WHEN lang = 'fr' THEN 'Texas RDC' ELSE 'Unknown RDC' END AS "ProjectRDC",
  CAST(s AS VARCHAR) AS "ProjectYearStarted", CAST(s + 3 AS VARCHAR) AS "ProjectYearEnded", coalesce(author, 'Unknown PI') AS "ProjectPI",
  wtitle AS "OutputTitle", CASE WHEN n_chars % 2 = 0 THEN 'DOI: 10.8/' || doc_id END AS "OutputBiblio",
  CASE WHEN doc_id IS NULL THEN NULL WHEN lang = 'en' THEN 'Journal Article' WHEN lang = 'de' THEN 'Thesis' ELSE 'Other' END AS "OutputType",
  CASE WHEN doc_id IS NOT NULL THEN 'Published' END AS "OutputStatus", 'Press ' || source AS "OutputVenue",
  CAST(n_chars % 40 + 1980 AS VARCHAR) AS "OutputYear", CASE WHEN doc_id IS NOT NULL THEN '06' END AS "OutputMonth",
  CAST(doc_id AS VARCHAR) AS "OutputVolume", CASE WHEN doc_id IS NOT NULL THEN '2' END AS "OutputNumber", CAST(NULL AS VARCHAR) AS "OutputPages",
  CASE WHEN n_chars % 2 = 0 THEN '10.8/' || doc_id END AS "DOI", 'CORE' AS "Source"
FROM b WHERE pick = 1
"""


@query("core_records", _CORE_SQL)
def core_records(t):
    return records.core_records(core_projects(t), landed_core(t), as_of_year=1999)


def _external_ids(kind, value):
    return F.struct(
        F.array(F.struct(kind.alias("external-id-type"), value.alias("external-id-value"))).alias("external-id")
    )


def _year_of(value):
    return F.struct(F.struct(value.cast("string").alias("value")).alias("year"))


def landed_persons(t):
    """Documents as people: every line is a work, the jobs come from the length."""
    works = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.struct(F.struct(line.alias("value")).alias("title")).alias("title"),
            F.lit("journal-article").alias("type"),
            F.when(i % 2 == 0, F.struct(F.concat(F.lit("Journal "), i).alias("value"))).alias("journal-title"),
            F.struct(
                F.struct((i + 1990).cast("string").alias("value")).alias("year"),
                F.struct(F.lit("03").alias("value")).alias("month"),
            ).alias("publication-date"),
            _external_ids(
                F.when(i % 3 == 0, "issn").otherwise("doi"), F.concat(F.lit("10.9/"), F.md5(line.cast("binary")))
            ).alias("external-ids"),
            F.struct(
                F.lit("formatted-unspecified").alias("citation-type"),
                F.concat(F.lit("Vol. "), i, F.lit(", No "), F.length(line), F.lit(", pp. "), i, F.lit("-"), i + 7).alias("citation-value"),
            ).alias("citation"),
        ),
    )
    n = F.col("n_chars")
    employments = F.array(
        F.struct(_year_of(n % 50 + 1950).alias("start-date"), _year_of(n % 30 + 1980).alias("end-date"),
                 F.struct(F.concat(F.lit("First "), "source").alias("name")).alias("organization")),
        F.struct(_year_of(n % 50 + 1960).alias("start-date"), _year_of(n % 20 + 1990).alias("end-date"),
                 F.struct(F.lit("Second").alias("name")).alias("organization")),
        F.struct(_year_of(n % 50 + 1970).alias("start-date"), F.when(n < 0, _year_of(n)).alias("end-date"),
                 F.struct(F.lit("Current").alias("name")).alias("organization")),
    )
    groups = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.array(
                F.struct(
                    i.cast("bigint").alias("put-code"),
                    _external_ids(F.lit("DOI"), F.concat(F.lit("10.9/"), F.md5(line.cast("binary")))).alias("external-ids"),
                )
            ).alias("work-summary")
        ),
    )
    record = F.to_json(
        F.struct(
            F.struct(
                F.struct(employments.alias("employment-summary")).alias("employments"),
                F.struct(groups.alias("group")).alias("works"),
            ).alias("activities-summary")
        )
    )
    return t.documents.select("doc_id", "lang", "text", "n_chars", record.alias("record_body"), F.to_json(works).alias("works_body"))


def persons(t):
    first_word = F.lower(F.get(F.split(title_line(), " "), F.lit(0)))
    return landed_persons(t).select(
        F.concat(F.lit("PROJ_"), "doc_id").alias("ProjID"),
        F.concat(F.lit("Ann "), "lang").alias("author"),
        first_word.alias("title"),
        (F.col("n_chars") % 40 + 1980).cast("string").alias("year"),
        parse_json("record_body", schemas.ORCID_RECORD).alias("record"),
        parse_json("works_body", schemas.ORCID_WORKS).alias("works"),
    )


_ORCID_SQL = """
WITH d AS (SELECT *, string_split(text, chr(10)) AS lines, n_chars % 40 + 1980 AS s,
  lower(string_split(string_split(text, chr(10))[1], ' ')[1]) AS title FROM documents),
x AS (SELECT *, list_filter(range(1, len(lines) + 1), lambda i: contains(lower(lines[i]), title))[-1] - 1 AS i FROM d)
SELECT 'PROJ_' || doc_id AS "ProjID", CASE WHEN s + 3 < 1999 THEN 'Completed' WHEN s <= 1999 THEN 'Active' ELSE 'Planned' END AS "ProjectStatus",
  title AS "ProjectTitle", CASE WHEN n_chars % 30 + 1980 >= n_chars % 20 + 1990 THEN 'First ' || source ELSE 'Second' END AS "ProjectRDC",
  CAST(s AS VARCHAR) AS "ProjectYearStarted", CAST(s + 3 AS VARCHAR) AS "ProjectYearEnded", 'Ann ' || lang AS "ProjectPI",
  lines[i + 1] AS "OutputTitle", CASE WHEN i % 3 <> 0 THEN 'doi:10.9/' || md5(lines[i + 1]) END AS "OutputBiblio", 'journal-article' AS "OutputType",
  'Published' AS "OutputStatus", CASE WHEN i % 2 = 0 THEN 'Journal ' || i WHEN i % 3 = 0 THEN '10.9/' || md5(lines[i + 1]) END AS "OutputVenue",
  CAST(i + 1990 AS VARCHAR) AS "OutputYear", '03' AS "OutputMonth", CAST(i AS VARCHAR) AS "OutputVolume",
  CAST(length(lines[i + 1]) AS VARCHAR) AS "OutputNumber", i || '-' || (i + 7) AS "OutputPages",
  CASE WHEN i % 3 <> 0 THEN '10.9/' || md5(lines[i + 1]) END AS "DOI", CAST(NULL AS VARCHAR) AS "Source"
FROM x
"""


@query("orcid_records", _ORCID_SQL)
def orcid_records(t):
    return records.orcid_records(persons(t), as_of_year=1999)


@query(
    "first_works",
    """
SELECT 'PROJ_' || doc_id AS "ProjID", coalesce(string_split(text, chr(10))[7], string_split(text, chr(10))[-1]) AS first_title,
  CAST(n_chars % 50 + 1950 AS VARCHAR) AS started, CAST(n_chars % 30 + 1980 AS VARCHAR) AS ended, 'First ' || source AS organisation
FROM documents
""",
)
def first_works(t):
    employments = F.col("record")["activities-summary"]["employments"]["employment-summary"]
    # The first group with a titled work is the seventh, or the last of fewer.
    titled = lambda w, i: (i >= 6) | (i == F.size("works") - 1)
    grouped = F.transform("works", lambda w, i: F.array(F.when(titled(w, i), w)))
    return persons(t).select(
        "ProjID",
        match.first_grouped_work(grouped)["title"]["title"]["value"].alias("first_title"),
        biblio.first_employment(employments).alias("job"),
    ).select("ProjID", "first_title", "job.*")


_LABEL = V.OUTPUT_TYPE_LABELS["journal-article"]


@query(
    "orcid_profiles",
    f"""
WITH d AS (SELECT *, string_split(text, chr(10)) AS lines FROM documents),
x AS (SELECT *, least(7, len(lines)) AS k FROM d),
y AS (SELECT *, CASE WHEN (k - 1) % 3 <> 0 THEN lines[k] END AS cited FROM x)
SELECT 'PROJ_' || doc_id AS "ProjID", 'Completed' AS "ProjectStatus", lower(string_split(lines[1], ' ')[1]) AS "ProjectTitle",
  'First ' || source AS "ProjectRDC", CAST(n_chars % 50 + 1950 AS VARCHAR) AS "ProjectYearStarted", CAST(n_chars % 30 + 1980 AS VARCHAR) AS "ProjectYearEnded",
  'Ann ' || lang AS "ProjectPI", lines[k] AS "OutputTitle", '. ' || cited || '. Journal of lines ' || length(cited) AS "OutputBiblio",
  '{_LABEL}' AS "OutputType", 'Published' AS "OutputStatus", CASE WHEN cited IS NOT NULL THEN 'Journal of lines' END AS "OutputVenue",
  CAST(k - 1 + 1990 AS VARCHAR) AS "OutputYear", CASE WHEN cited IS NOT NULL AND length(cited) % 2 = 0 THEN '9' ELSE '03' END AS "OutputMonth",
  CAST(length(cited) AS VARCHAR) AS "OutputVolume", CAST(NULL AS VARCHAR) AS "OutputNumber", CAST(NULL AS VARCHAR) AS "OutputPages",
  '10.9/' || md5(cited) AS "DOI"
FROM y
""",
)
def orcid_profiles(t):
    titled = lambda w, i: (i >= 6) | (i == F.size("works") - 1)
    groups = F.transform("works", lambda w, i: F.array(F.when(titled(w, i), w)))
    lines = t.documents.select(F.explode(F.split("text", "\n")).alias("line")).distinct()
    month = F.when(F.length("line") % 2 == 0, F.array(F.array(F.lit(2001), F.lit(9))))
    body = F.to_json(
        F.struct(
            F.array("line").alias("title"), F.array(F.lit("Journal of lines")).alias("container-title"),
            F.length("line").cast("string").alias("volume"), F.struct(month.alias("date-parts")).alias("published-print"),
        )
    )
    messages = lines.select(
        F.concat(F.lit("10.9/"), F.md5(F.col("line").cast("binary"))).alias("key"),
        parse_json(body, schemas.CROSSREF_MESSAGE).alias("msg"),
    )
    return records.orcid_profile_records(persons(t).withColumn("groups", groups), messages)


@query(
    "work_for_doi",
    """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
SELECT doc_id AS orcid, '10.9/' || md5(lines[-1]) AS doi, CAST(list_position(lines, lines[-1]) - 1 AS BIGINT) AS put_code FROM d
UNION ALL SELECT doc_id, NULL, NULL FROM d
UNION ALL SELECT doc_id, '10.9/none', NULL FROM d
""",
)
def work_for_doi(t):
    people = landed_persons(t).select(
        F.col("doc_id").alias("orcid"), parse_json("record_body", schemas.ORCID_RECORD).alias("record")
    )
    last = F.concat(F.lit("10.9/"), F.md5(F.element_at(F.split("text", "\n"), -1).cast("binary")))
    dois = F.array(last, F.lit(None).cast("string"), F.lit("10.9/none"))
    rows = t.documents.select(F.col("doc_id").alias("orcid"), F.explode(dois).alias("doi"))
    return match.work_for_doi(rows, people, "orcid")


def enrichable(t):
    """Line items as records with gaps, each with the work its DOI names."""
    lines = citations(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", "cite",
        F.when(F.col("l_partkey") % 4 != 0, "Old venue").alias("OutputVenue"),
        F.when(F.col("l_partkey") % 8 > 2, "old").alias("OutputVolume"),
        F.when(F.col("l_partkey") % 5 == 0, "old").alias("OutputNumber"),
        F.when(F.col("l_partkey") % 7 == 0, "old").alias("OutputPages"),
        F.when(F.col("l_partkey") % 2 == 0, "01").alias("OutputMonth"),
    )
    body = F.to_json(
        F.struct(
            F.struct(F.lit("New venue").alias("value")).alias("journal-title"),
            F.struct(F.struct(F.lit("12").alias("value")).alias("month")).alias("publication-date"),
            F.struct(F.col("cite").alias("citation-value")).alias("citation"),
        )
    )
    return lines.withColumn(
        "work", F.when(F.col("l_linenumber") != 2, parse_json(body, schemas.ORCID_WORK))
    ).drop("cite")


def _enrich_field(name: str, old: str, compact: int, dated: int) -> str:
    a = f"nullif(regexp_extract(cite, '{V.CITATION_VOLUME_ISSUE_PAGES}', {compact}), '')"
    b = f"nullif(regexp_extract(cite, '{V.CITATION_YEAR_VOLUME_ISSUE_PAGES}', {dated}), '')"
    return f"coalesce(CASE WHEN done THEN {old} ELSE coalesce({a}, {old}) END, {b}) AS \"{name}\""


@query(
    "enrich_from_work",
    f"""
WITH o AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber <> 2 THEN cite END AS cite,
  CASE WHEN l_partkey % 4 <> 0 THEN 'Old venue' END AS venue, CASE WHEN l_partkey % 8 > 2 THEN 'old' END AS volume,
  CASE WHEN l_partkey % 5 = 0 THEN 'old' END AS number, CASE WHEN l_partkey % 7 = 0 THEN 'old' END AS pages FROM ({CITATION_SQL})),
d AS (SELECT *, venue IS NOT NULL AND volume IS NOT NULL AS done FROM o)
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN done OR l_linenumber = 2 THEN venue ELSE 'New venue' END AS "OutputVenue",
  {_enrich_field('OutputVolume', 'volume', 1, 2)}, {_enrich_field('OutputNumber', 'number', 2, 3)}, {_enrich_field('OutputPages', 'pages', 3, 4)},
  CASE WHEN l_partkey % 2 = 0 THEN '01' WHEN l_linenumber <> 2 THEN '12' END AS "OutputMonth"
FROM d
""",
)
def enrich_from_work(t):
    return records.enrich_from_orcid_work(enrichable(t)).drop("work")


@query(
    "related_records",
    f"""
WITH c AS (SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 'University of Michigan, Ann Arbor' WHEN c_nationkey = 4 THEN 'Texas RDC lab' ELSE 'Nation ' || c_nationkey END AS rdc,
  c_mktsegment AS pt, c_name AS ot, CASE WHEN c_acctbal > 9000 THEN 'Title 13 review' END AS ov, 'results ' || c_mktsegment AS ob, CASE WHEN c_nationkey > 20 THEN 'Bea Irs' ELSE 'X Y' END AS pi FROM customer)
SELECT c_custkey, {sql_case('rdc', V.CENTRE_NAMES, 'rdc')} AS "ProjectRDC" FROM c
WHERE {sql_contains('rdc', V.RELATED_KEYWORDS_LONG)} OR {sql_contains('pt', V.RELATED_KEYWORDS_LONG)} OR {sql_contains('ot', V.RELATED_KEYWORDS_LONG)}
  OR {sql_contains("coalesce(ov, '')", V.RELATED_KEYWORDS_LONG)} OR {sql_contains("pi", V.RELATED_KEYWORDS_LONG)}
  OR {sql_contains("ob", V.RELATED_KEYWORDS_LONG)}
""",
)
def related_records(t):
    nation = F.col("c_nationkey")
    rdc = (
        F.when(nation == 0, "University of Michigan, Ann Arbor").when(nation == 4, "Texas RDC lab")
        .otherwise(F.concat(F.lit("Nation "), nation))
    )
    rows = t.customer.select(
        "c_custkey", rdc.alias("ProjectRDC"), F.col("c_mktsegment").alias("ProjectTitle"),
        F.col("c_name").alias("OutputTitle"),
        F.when(F.col("c_acctbal") > 9000, "Title 13 review").alias("OutputVenue"),
        F.concat(F.lit("results "), "c_mktsegment").alias("OutputBiblio"),
        F.when(nation > 20, "Bea Irs").otherwise("X Y").alias("ProjectPI"),
    )
    return records.related_records(rows).select("c_custkey", "ProjectRDC")


_COMBINED_SQL = f"""
WITH u AS (
  SELECT * REPLACE ('PMC' AS "Source") FROM ({_ARTICLE_SQL})
  UNION ALL SELECT * REPLACE ('OpenAlex' AS "Source") FROM ({_OPENALEX_SQL})
  UNION ALL SELECT * FROM ({_CORE_SQL})
  UNION ALL SELECT * REPLACE ('ORCID' AS "Source") FROM ({_ORCID_SQL})),
k AS (SELECT *, "Source" || ':' || "ProjID" AS id,
  {' + '.join(f'("{c}" IS NULL)::INT' for c in schemas.OUTPUT_COLUMNS)} AS missing,
  CASE WHEN nullif(trim("DOI"), '') IS NOT NULL THEN 'd' || lower(trim("DOI"))
    WHEN nullif(trim("OutputTitle"), '') IS NOT NULL
    THEN 't' || lower(trim(regexp_replace("OutputTitle", '\\s+', ' ', 'g'))) || chr(10) || lower("ProjectPI")
    ELSE 'i' || "Source" || ':' || "ProjID" END AS key
  FROM u WHERE "OutputTitle" IS NOT NULL)
SELECT * EXCLUDE (id, missing, key, r) FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY missing, id) AS r FROM k) WHERE r = 1
"""


@query("combined_records", _COMBINED_SQL)
def combined_records(t):
    return pipeline.combine(
        {
            "PMC": article_records(t), "OpenAlex": openalex_records(t),
            "CORE": core_records(t), "ORCID": orcid_records(t),
        }
    )


@query(
    "doi_among_ids",
    """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
SELECT doc_id, md5(lines[1]) = md5(lines[-1]) AS same_work FROM d
""",
)
def doi_among_ids(t):
    """Does the first listed work carry the DOI of the last?"""
    groups = F.col("record")["activities-summary"]["works"]["group"]
    first = F.get(F.get(groups, F.lit(0))["work-summary"], F.lit(0))["external-ids"]["external-id"]
    last_line = F.element_at(F.split("text", "\n"), -1)
    wanted = F.upper(F.concat(F.lit("10.9/"), F.md5(last_line.cast("binary"))))
    people = landed_persons(t).select(
        "doc_id", wanted.alias("doi"), parse_json("record_body", schemas.ORCID_RECORD).alias("record")
    )
    return people.select("doc_id", predicates.has_doi(first, "doi").alias("same_work"))
