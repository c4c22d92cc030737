"""Text, identifier, predicate and bibliography expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from scholarweave import vocabulary as V
from scholarweave.functions import biblio, predicates, text
from scholarweave.plans.registry import query


def sql_contains(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({expr}), '{w.lower()}')" for w in words) + ")"


def sql_case(expr: str, pairs, default: str) -> str:
    arms = " ".join(f"WHEN contains(lower({expr}), '{k}') THEN '{v}'" for k, v in pairs)
    return f"CASE {arms} ELSE {default} END"


def sql_lookup(expr: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE lower({expr}) {arms} ELSE {default} END"


@query(
    "keyword_filter",
    f"SELECT doc_id FROM documents WHERE {sql_contains('text', V.RELATED_KEYWORDS)}",
)
def keyword_filter(t):
    return t.documents.where(predicates.is_related("text")).select("doc_id")


def page_works(t):
    """Pages as works: title, text, keyword list and institutions."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return t.pages.select(
        "page_id",
        F.struct(
            title.alias("title"),
            F.lit(None).cast("string").alias("abstract"),
            F.col("html").alias("fullText"),
            F.split("url", "/").alias("keywords"),
            F.array(F.struct(F.concat(title, F.lit(" RDC")).alias("name"))).alias("institutions"),
        ).alias("work"),
    )


_PAGE_TEXT = (
    "concat_ws(' ', nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), html, "
    "array_to_string(list_filter(string_split(url, '/'), lambda k: k <> ''), ' '), "
    "regexp_extract(html, '<title>([^<]*)</title>', 1) || ' RDC')"
)


@query(
    "work_filter",
    f"SELECT page_id, {sql_contains(_PAGE_TEXT, V.RELATED_KEYWORDS_LONG)} AS related FROM pages",
)
def work_filter(t):
    return page_works(t).select("page_id", predicates.is_related_work(F.col("work")).alias("related"))


@query(
    "record_filter",
    "SELECT conv_id, turn FROM conversations WHERE "
    + " OR ".join(sql_contains(f"coalesce({c}, '')", V.RELATED_KEYWORDS_LONG) for c in ("role", "text")),
)
def record_filter(t):
    return t.conversations.where(predicates.is_related_record(["role", "text"])).select("conv_id", "turn")


@query(
    "relatedness_counts",
    f"""
SELECT source, count(*) AS works,
       count(*) FILTER (WHERE {sql_contains('text', V.RELATED_KEYWORDS)}) AS short_list,
       count(*) FILTER (WHERE {sql_contains('text', V.RELATED_KEYWORDS_LONG)}) AS long_list
FROM documents GROUP BY source
""",
)
def relatedness_counts(t):
    return t.documents.groupBy("source").agg(
        F.count(F.lit(1)).alias("works"),
        F.count_if(predicates.is_related("text")).alias("short_list"),
        F.count_if(predicates.contains_any("text", V.RELATED_KEYWORDS_LONG)).alias("long_list"),
    )


INSTITUTIONS = [
    "University of Michigan, Ann Arbor", "TEXAS A&M", "Boston University with Cornell",
    "City University of New York", "Univ. of North Carolina", "UC Berkeley", "Elsewhere College",
]
_INSTITUTION_SQL = "CASE c_nationkey " + " ".join(
    f"WHEN {k} THEN '{name}'" for k, name in enumerate(INSTITUTIONS)
) + " WHEN 7 THEN NULL ELSE 'Nation ' || c_nationkey END"


def institution():
    chain = F.when(F.col("c_nationkey") == 0, INSTITUTIONS[0])
    for k, name in enumerate(INSTITUTIONS[1:], start=1):
        chain = chain.when(F.col("c_nationkey") == k, name)
    return chain.when(F.col("c_nationkey") == 7, None).otherwise(
        F.concat(F.lit("Nation "), "c_nationkey")
    )


@query(
    "centre_names",
    f"""
WITH c AS (SELECT c_custkey, c_mktsegment, {_INSTITUTION_SQL} AS inst FROM customer)
SELECT c_custkey, {sql_case('inst', V.CENTRE_NAMES, 'inst')} AS standard,
  {sql_case("concat_ws(' ', c_mktsegment, inst)", V.CENTRE_NAMES, "'Unknown RDC'")} AS inferred
FROM c
""",
)
def centre_names(t):
    customers = t.customer.select("c_custkey", "c_mktsegment", institution().alias("inst"))
    listed = F.transform(F.array("c_mktsegment", "inst"), lambda n: F.struct(n.alias("name")))
    return customers.select(
        "c_custkey",
        biblio.standard_centre("inst").alias("standard"),
        biblio.infer_centre(listed).alias("inferred"),
    )


@query(
    "detected_centre",
    """
WITH n AS (
  SELECT o_orderkey, list_filter([o_orderpriority || ' RDC', CASE WHEN o_orderstatus = 'F' THEN 'Census Bureau' END, 'hardcore'],
    lambda x: x IS NOT NULL) AS names, o_orderstatus FROM orders)
SELECT o_orderkey, list_filter(CASE WHEN o_orderstatus = 'P' THEN names[2:] ELSE names END,
  lambda x: contains(lower(x), 'census bureau') OR regexp_matches(x, '(?i)\\bRDC\\b'))[1] AS centre
FROM n
""",
)
def detected_centre(t):
    def place(name):
        return F.struct(name.alias("display_name"))

    first = F.when(
        F.col("o_orderstatus") != "P",
        F.array(place(F.concat("o_orderpriority", F.lit(" RDC")))),
    )
    second = F.array(
        place(F.when(F.col("o_orderstatus") == "F", "Census Bureau")), place(F.lit("hardcore"))
    )
    authorships = F.array(F.struct(first.alias("institutions")), F.struct(second.alias("institutions")))
    return t.orders.select("o_orderkey", biblio.detect_centre(authorships).alias("centre"))


WORK_TYPES = ["journal-article", "Book-Chapter", "conference-paper", "working-paper", "review", ""]
_TYPE_SQL = "CASE p_type " + " ".join(
    f"WHEN '{p}' THEN '{w}'"
    for p, w in zip(["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"], WORK_TYPES)
) + " END"


def work_type():
    chain = F.when(F.col("p_type") == "ECONOMY", WORK_TYPES[0])
    for p, w in zip(["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"], WORK_TYPES[1:]):
        chain = chain.when(F.col("p_type") == p, w)
    return chain


@query(
    "type_codes",
    f"""
WITH p AS (SELECT p_partkey, p_size, {_TYPE_SQL} AS w FROM part)
SELECT p_partkey,
  {sql_lookup('w', V.OUTPUT_TYPE_CODES, "'OT'")} AS code,
  {sql_lookup('w', V.OUTPUT_TYPE_CODES, 'upper(w)')} AS code_or_type,
  CASE WHEN p_size > 45 THEN 'Unknown' ELSE
  {sql_lookup('w', {**V.OUTPUT_TYPE_LABELS, 'working-paper': 'Working Paper'}, "'Publication'")} END AS label,
  {sql_case('w', V.OUTPUT_TYPE_GUESSES, "'Other'")} AS guess
FROM p
""",
)
def type_codes(t):
    return t.part.select("p_partkey", "p_size", work_type().alias("w")).select(
        "p_partkey",
        biblio.type_code("w").alias("code"),
        biblio.type_code("w", keep_unknown=True).alias("code_or_type"),
        biblio.type_label("w", F.col("p_size") <= 45).alias("label"),
        biblio.type_guess("w").alias("guess"),
    )


# Each ship status gets another citation style.
CITATION_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, CASE
  WHEN l_returnflag = 'A' THEN 'J. ' || l_partkey || ' ' || l_linenumber || '(' || l_suppkey || '),  ' || l_orderkey || '-' || (l_orderkey + 9) || '.'
  WHEN l_returnflag = 'N' THEN 'Env. Sci. ' || year(l_shipdate) || ', ' || l_linenumber || ' (' || l_suppkey || '), ' || l_orderkey || '-' || l_partkey
  WHEN l_linestatus = 'O' THEN 'Review, Volume ' || l_linenumber || ', Issue. ' || l_suppkey || ', pp. ' || l_orderkey || ' – ' || l_partkey
  ELSE 'no numbers here' END AS cite FROM lineitem
"""


def citations(t):
    c = F.col
    compact = F.concat(
        F.lit("J. "), c("l_partkey"), F.lit(" "), c("l_linenumber"), F.lit("("), c("l_suppkey"),
        F.lit("),  "), c("l_orderkey"), F.lit("-"), c("l_orderkey") + 9, F.lit("."),
    )
    dated = F.concat(
        F.lit("Env. Sci. "), F.year("l_shipdate"), F.lit(", "), c("l_linenumber"), F.lit(" ("),
        c("l_suppkey"), F.lit("), "), c("l_orderkey"), F.lit("-"), c("l_partkey"),
    )
    labelled = F.concat(
        F.lit("Review, Volume "), c("l_linenumber"), F.lit(", Issue. "), c("l_suppkey"),
        F.lit(", pp. "), c("l_orderkey"), F.lit(" – "), c("l_partkey"),
    )
    cite = (
        F.when(c("l_returnflag") == "A", compact)
        .when(c("l_returnflag") == "N", dated)
        .when(c("l_linestatus") == "O", labelled)
        .otherwise("no numbers here")
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", cite.alias("cite"))


def _groups(prefix: str, pattern: str, groups) -> str:
    return ", ".join(
        f"nullif(regexp_extract(cite, '{pattern}', {g}), '') AS {prefix}_{name}"
        for name, g in zip(("volume", "number", "pages"), groups)
    )


_LABELLED_SQL = ", ".join(
    f"nullif(regexp_extract(cite, '{p}', {g}), '') AS labelled_{n}"
    for n, p, g in (
        ("volume", V.CITATION_VOLUME, 1), ("number", V.CITATION_ISSUE, 2), ("pages", V.CITATION_PAGES, 1),
    )
)


@query(
    "citation_parse",
    f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  {_groups('compact', V.CITATION_VOLUME_ISSUE_PAGES, (1, 2, 3))},
  {_groups('dated', V.CITATION_YEAR_VOLUME_ISSUE_PAGES, (2, 3, 4))},
  {_LABELLED_SQL}
FROM ({CITATION_SQL})
""",
)
def citation_parse(t):
    parsed = citations(t).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        biblio.citation_compact("cite").alias("compact"),
        biblio.citation_dated("cite").alias("dated"),
        biblio.citation_labelled("cite").alias("labelled"),
    )
    return parsed.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        *[
            F.col(f"{kind}.{part}").alias(f"{kind}_{part}")
            for kind in ("compact", "dated", "labelled")
            for part in ("volume", "number", "pages")
        ],
    )


_PART_FIELDS_SQL = """
SELECT p_partkey, p_name AS journal,
  CASE WHEN p_size > 5 THEN CAST(p_size AS VARCHAR) ELSE '' END AS volume,
  CASE WHEN p_type <> 'LARGE' THEN p_brand END AS issue,
  CASE WHEN p_size % 3 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS first,
  CASE WHEN p_size % 2 = 0 THEN CAST(p_partkey + p_size AS VARCHAR) ELSE '' END AS last
FROM part
"""


def part_fields(t):
    size, key = F.col("p_size"), F.col("p_partkey")
    return t.part.select(
        "p_partkey",
        F.col("p_name").alias("journal"),
        F.when(size > 5, size.cast("string")).otherwise("").alias("volume"),
        F.when(F.col("p_type") != "LARGE", F.col("p_brand")).alias("issue"),
        F.when(size % 3 != 0, key.cast("string")).alias("first"),
        F.when(size % 2 == 0, (key + size).cast("string")).otherwise("").alias("last"),
    )


@query(
    "citation_build",
    f"""
WITH f AS ({_PART_FIELDS_SQL}),
g AS (SELECT *, CASE WHEN first IS NULL THEN NULL WHEN last = '' THEN first ELSE first || '-' || last END AS pages,
  nullif(CASE WHEN first IS NULL THEN last WHEN last = '' THEN first ELSE first || '-' || last END, '') AS either FROM f)
SELECT p_partkey, pages, either,
  CASE WHEN volume <> '' AND issue <> '' AND pages <> '' THEN
    journal || ', Vol ' || volume || ', Iss ' || issue || ', pp. ' || pages END AS complete,
  journal || ', Vol ' || volume || ', Iss ' || coalesce(issue, '') || ', pp. ' || coalesce(either, '') AS loose,
  CASE WHEN issue IS NOT NULL THEN 'doi:' || issue END AS doi_short,
  CASE WHEN issue IS NOT NULL THEN 'DOI: ' || issue END AS doi_long
FROM g
""",
)
def citation_build(t):
    f = part_fields(t)
    pages, either = biblio.page_range("first", "last"), biblio.page_range_either("first", "last")
    return f.select(
        "p_partkey", pages.alias("pages"), either.alias("either"),
        biblio.full_citation("journal", "volume", "issue", pages).alias("complete"),
        biblio.loose_citation("journal", "volume", "issue", either).alias("loose"),
        biblio.doi_reference("issue").alias("doi_short"),
        biblio.doi_reference("issue", "DOI: ").alias("doi_long"),
    )


# The SQL engine has no look-behind; it may start anywhere in a run of words.
TITLE_PATTERN_SQL = (
    r"(?i)(FSRDC:?\s*)?([\p{L}\p{N}_\s-]+?)(?:using|based|analysis|study|research|$)"
)


@query(
    "project_title",
    f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10))[1] AS title FROM documents)
SELECT doc_id,
  CASE WHEN regexp_matches(title, '{TITLE_PATTERN_SQL}')
    THEN trim(regexp_extract(title, '{TITLE_PATTERN_SQL}', 2)) ELSE substr(title, 1, 100) END AS project_title,
  CASE WHEN contains(lower(title), 'fsrdc') THEN title ELSE 'FSRDC Project' END AS tagged_title
FROM d
""",
)
def project_title(t):
    titles = t.documents.select("doc_id", F.get(F.split("text", "\n"), F.lit(0)).alias("title"))
    return titles.select(
        "doc_id",
        text.project_title("title").alias("project_title"),
        text.project_title_or_default("title").alias("tagged_title"),
    )


RAW_YEAR_SQL = """
SELECT o_orderkey, CASE o_orderpriority
  WHEN '1-URGENT' THEN CAST(year(o_orderdate) AS VARCHAR)
  WHEN '2-HIGH' THEN ' ' || year(o_orderdate) || chr(9)
  WHEN '3-MEDIUM' THEN year(o_orderdate) || '.0'
  WHEN '4-NOT SPECIFIED' THEN 'c. ' || year(o_orderdate) ELSE NULL END AS raw,
  CASE o_orderstatus WHEN 'F' THEN CAST(year(o_orderdate) + 1 AS VARCHAR) WHEN 'O' THEN 'Ongoing' ELSE '' END AS ended
FROM orders
"""


def raw_years(t):
    y = F.year("o_orderdate").cast("string")
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        F.when(p == "1-URGENT", y)
        .when(p == "2-HIGH", F.concat(F.lit(" "), y, F.lit("\t")))
        .when(p == "3-MEDIUM", F.concat(y, F.lit(".0")))
        .when(p == "4-NOT SPECIFIED", F.concat(F.lit("c. "), y)).alias("raw"),
        F.when(s == "F", (F.year("o_orderdate") + 1).cast("string"))
        .when(s == "O", "Ongoing").otherwise("").alias("ended"),
    )


@query(
    "clean_year_status",
    f"""
WITH r AS ({RAW_YEAR_SQL}),
y AS (SELECT *, CAST(TRY_CAST(trim(raw, ' ' || chr(9)) AS DOUBLE) AS INTEGER) AS s FROM r)
SELECT o_orderkey, CAST(s AS VARCHAR) AS started, CAST(s + 3 AS VARCHAR) AS ends,
  CASE WHEN s IS NULL THEN 'Unknown' WHEN s + 3 < 1999 THEN 'Completed' WHEN s <= 1999 THEN 'Active' ELSE 'Planned' END AS status,
  CASE WHEN ended NOT IN ('', 'Ongoing') THEN 'Completed' ELSE 'Active' END AS status_by_end,
  CASE WHEN raw IS NULL THEN 'In Progress' ELSE 'Published' END AS output_status
FROM y
""",
)
def clean_year_status(t):
    start = text.clean_year("raw")
    end = biblio.end_year(start)
    return raw_years(t).select(
        "o_orderkey", start.alias("started"), end.alias("ends"),
        biblio.project_status(start, end, as_of_year=1999).alias("status"),
        biblio.status_from_end("ended").alias("status_by_end"),
        biblio.output_status("raw").alias("output_status"),
    )


@query(
    "name_tokens",
    """
WITH n AS (SELECT p_partkey, CASE WHEN p_size > 40 THEN p_name || ' ; ' || p_brand
  WHEN p_size > 30 THEN p_brand || ', ' || p_name WHEN p_size > 25 THEN '  ' WHEN p_size > 20 THEN NULL
  WHEN p_size > 15 THEN 'Unknown PI' ELSE p_name END AS author FROM part)
SELECT p_partkey, nullif(string_split(trim(string_split(string_split(author, ';')[1], ',')[1]), ' ')[1], '') AS first_author,
  nullif(string_split(trim(author), ' ')[1], '') AS given, nullif(string_split(trim(author), ' ')[-1], '') AS family,
  coalesce(lower(author) <> 'unknown pi' AND len(string_split(trim(author), ' ')) >= 2, false) AS valid
FROM n
""",
)
def name_tokens(t):
    size = F.col("p_size")
    author = (
        F.when(size > 40, F.concat("p_name", F.lit(" ; "), "p_brand"))
        .when(size > 30, F.concat("p_brand", F.lit(", "), "p_name"))
        .when(size > 25, "  ").when(size > 20, None).when(size > 15, "Unknown PI")
        .otherwise(F.col("p_name"))
    )
    return t.part.select("p_partkey", author.alias("author")).select(
        "p_partkey",
        text.first_author("author").alias("first_author"),
        text.first_token("author").alias("given"),
        text.last_token("author").alias("family"),
        predicates.is_valid_pi("author").alias("valid"),
    )


@query(
    "doi_forms",
    """
WITH d AS (SELECT p_partkey, ' 10.' || p_size || '/' || upper(p_name) || '~*+' || p_brand || ' ' AS doi FROM part)
SELECT p_partkey, lower(trim(doi)) AS doi, url_encode(lower(trim(doi))) AS encoded FROM d
""",
)
def doi_forms(t):
    doi = F.concat(
        F.lit(" 10."), "p_size", F.lit("/"), F.upper("p_name"), F.lit("~*+"), "p_brand", F.lit(" ")
    )
    return t.part.select("p_partkey", text.norm_doi(doi).alias("doi")).select(
        "p_partkey", "doi", text.encode_doi("doi").alias("encoded")
    )


@query(
    "id_filters",
    """
SELECT page_id, string_split(url, '/')[-1] AS last_segment FROM pages
WHERE starts_with(url, 'https://')
""",
)
def id_filters(t):
    return t.pages.where(predicates.has_id_prefix("url", "https://")).select(
        "page_id", text.last_path_segment("url").alias("last_segment")
    )


@query(
    "labels_dates",
    """
WITH d AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
  'Order of ' || o_orderpriority || ' for customer ' || o_custkey AS title FROM orders)
SELECT o_orderkey, string_split(day, '-')[1] AS year, string_split(day, '-')[2] AS month,
  substr(day, 6, 2) AS month_sliced, substr(title, 1, 20) || '...' || chr(10) || string_split(day, '-')[1] AS label
FROM d
""",
)
def labels_dates(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    title = F.concat(F.lit("Order of "), "o_orderpriority", F.lit(" for customer "), "o_custkey")
    return t.orders.select("o_orderkey", day.alias("day"), title.alias("title")).select(
        "o_orderkey",
        text.date_year("day").alias("year"),
        text.date_month("day").alias("month"),
        F.substring("day", 6, 2).alias("month_sliced"),
        text.short_label("title", text.date_year("day")).alias("label"),
    )


@query(
    "keyword_lists",
    """
WITH k AS (SELECT p_partkey, list_transform(string_split(replace(p_name, ' ', ' , ') || ', ,' || lower(p_type) || ',', ','),
  lambda x: trim(x)) AS words FROM part)
SELECT p_partkey, unnest(list_distinct(list_filter(words, lambda x: x <> ''))) AS keyword FROM k
""",
)
def keyword_lists(t):
    listed = F.concat(
        F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(", ,"), F.lower("p_type"), F.lit(",")
    )
    return t.part.select("p_partkey", F.explode(text.keywords(listed)).alias("keyword"))


@query(
    "fill_and_override",
    """
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END, o_orderstatus) AS filled,
  coalesce(nullif(CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderstatus = 'P' THEN 'new' END, ''), o_orderpriority) AS overridden,
  coalesce(nullif(trim(CASE WHEN o_orderstatus = 'O' THEN '  ' END), ''), nullif(trim(o_orderpriority), '')) AS first_given
FROM orders
""",
)
def fill_and_override(t):
    s = F.col("o_orderstatus")
    rows = t.orders.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        F.when(s != "F", F.col("o_orderpriority")).alias("cur"),
        F.when(s == "O", "").when(s == "P", "new").alias("new"),
        F.when(s == "O", "  ").alias("blank"),
    )
    return rows.select(
        "o_orderkey",
        text.fill_if_null("cur", "o_orderstatus").alias("filled"),
        text.override("o_orderpriority", "new").alias("overridden"),
        text.first_nonempty("blank", "o_orderpriority").alias("first_given"),
    )


@query(
    "enrich_mask",
    """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS volume,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS venue,
  CASE WHEN o_custkey > 100 THEN 'd' || o_custkey ELSE ' ' END AS doi FROM orders)
SELECT o_orderkey, (volume IS NULL OR venue IS NULL) AND trim(doi) <> '' AS needs,
  volume IS NOT NULL AND venue IS NOT NULL AS done
FROM r
""",
)
def enrich_mask(t):
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("volume"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("venue"),
        F.when(F.col("o_custkey") > 100, F.concat(F.lit("d"), "o_custkey")).otherwise(" ").alias("doi"),
    )
    return rows.select(
        "o_orderkey",
        predicates.needs_enrichment(["volume", "venue"], ["doi"]).alias("needs"),
        predicates.already_enriched(["volume", "venue"]).alias("done"),
    )
