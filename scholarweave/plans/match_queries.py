"""Joins, lookups, harmonising and de-duplication."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from scholarweave import schemas
from scholarweave.operators import entities, frequency, harmonise, match, title_search as search
from scholarweave.plans.registry import query
from scholarweave.sources.payloads import parse_json

# --- harmonising -------------------------------------------------------------

HARMONISED_SQL = """
SELECT c_name AS author, CAST(1990 + c_nationkey AS VARCHAR) AS year, trim(c_mktsegment) AS title, '10.1/' || c_custkey AS doi
FROM customer WHERE c_nationkey <> 3
UNION ALL
SELECT CASE WHEN s_nationkey > 12 THEN s_name ELSE 'Deputy ' || s_suppkey END, CAST(s_nationkey AS VARCHAR), 'Supply of ' || s_nationkey,
  CASE WHEN s_nationkey <> 5 THEN '10.2/' || s_suppkey END FROM supplier WHERE s_nationkey <> 5
"""


def group_frames(t) -> dict:
    """Three groups of records whose headers differ; the third has no DOI column."""
    nation = F.col("c_nationkey")
    customers = t.customer.select(
        F.concat(F.lit(" "), "c_name", F.lit("; Second, Author")).alias("Researchers"),
        F.when(nation != 3, (nation + 1990).cast("string")).otherwise("nan").alias("ProjectEndYear"),
        F.concat("c_mktsegment", F.lit(", part two")).alias("ProjectTitle"),
        F.concat(F.lit("10.1/"), "c_custkey").alias("DOI"),
        F.col("c_acctbal").cast("string").alias("Balance"),
    )
    suppliers = t.supplier.select(
        F.when(F.col("s_nationkey") > 12, F.col("s_name")).otherwise(" , ").alias("PI"),
        F.concat(F.lit("Deputy "), "s_suppkey").alias("project_pi"),
        F.col("s_nationkey").cast("string").alias("Year"),
        F.concat(F.lit("Supply of "), "s_nationkey").alias("Title"),
        F.when(F.col("s_nationkey") != 5, F.concat(F.lit("10.2/"), "s_suppkey")).alias("doi"),
    )
    parts = t.part.select(
        F.col("p_name").alias("Author"), F.col("p_size").cast("string").alias("Year"),
        F.col("p_brand").alias("Title"),
    )
    return {"group1": customers, "group2": suppliers, "group3": parts}


@query("harmonise_union", HARMONISED_SQL)
def harmonise_union(t):
    frames = [harmonise.harmonise(f) for f in group_frames(t).values()]
    return harmonise.union_complete(frames)


_NORM_TEXT = "lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))"


@query(
    "dedupe_records",
    f"""
SELECT doc_id, lang, source FROM documents d WHERE doc_id IN (
  SELECT min(doc_id) FROM documents GROUP BY {_NORM_TEXT}, lower(lang))
""",
)
def dedupe_records(t):
    records = t.documents.select(
        "doc_id", "lang", "source", "text", F.lit(None).cast("string").alias("doi")
    )
    kept = harmonise.dedupe(records, "doc_id", title="text", author="lang")
    return kept.select("doc_id", "lang", "source")


@query(
    "dedupe_by_doi",
    """
WITH r AS (SELECT l_orderkey * 1000000000 + l_partkey * 10000 + l_suppkey * 10 + l_linenumber AS id,
  CASE WHEN l_returnflag <> 'R' THEN '10.3/' || l_partkey END AS doi,
  CASE WHEN l_linestatus = 'O' THEN 'Part ' || l_partkey || ' of supplier' END AS title,
  CASE WHEN l_discount > 0.03 THEN 's' || l_suppkey END AS author FROM lineitem),
k AS (SELECT *, (doi IS NULL)::INT + (title IS NULL)::INT + (author IS NULL)::INT AS missing,
  CASE WHEN doi IS NOT NULL THEN 'd' || doi WHEN title IS NOT NULL THEN 't' || lower(title) || chr(10) || coalesce(author, '')
       ELSE 'i' || id END AS key FROM r)
SELECT id, doi, title, author FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY missing, id) AS r FROM k) WHERE r = 1
""",
)
def dedupe_by_doi(t):
    key = (
        F.col("l_orderkey") * 1000000000 + F.col("l_partkey") * 10000
        + F.col("l_suppkey") * 10 + F.col("l_linenumber")
    )
    spelled = F.when(F.col("l_linenumber") > 3, F.concat(F.lit(" 10.3/"), "l_partkey", F.lit(" "))).otherwise(
        F.concat(F.lit("10.3/"), "l_partkey")
    )
    records = t.lineitem.select(
        key.alias("id"),
        F.when(F.col("l_returnflag") != "R", spelled).alias("doi"),
        F.when(
            F.col("l_linestatus") == "O", F.concat(F.lit("Part "), "l_partkey", F.lit(" of  supplier"))
        ).alias("title"),
        F.when(F.col("l_discount") > 0.03, F.concat(F.lit("S"), "l_suppkey")).alias("author"),
    )
    kept = harmonise.dedupe(records, "id")
    return kept.select(
        "id", F.trim("doi").alias("doi"), F.replace("title", F.lit("  "), F.lit(" ")).alias("title"),
        F.lower("author").alias("author"),
    )


@query(
    "conform_record",
    """
SELECT CAST(c_custkey AS VARCHAR) AS "ProjID", 'Unknown' AS "ProjectStatus", c_mktsegment AS "ProjectTitle",
  'Unknown' AS "ProjectRDC", '' AS "ProjectYearStarted", '' AS "ProjectYearEnded", c_name AS "ProjectPI",
  c_mktsegment AS "OutputTitle", '' AS "OutputBiblio", 'Publication' AS "OutputType", 'Unknown' AS "OutputStatus",
  '' AS "OutputVenue", CAST(1990 + c_nationkey AS VARCHAR) AS "OutputYear", '' AS "OutputMonth", '' AS "OutputVolume",
  '' AS "OutputNumber", '' AS "OutputPages", '' AS "DOI", 'customer' AS "Source"
FROM customer
""",
)
def conform_record(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("ProjID"), F.col("c_name").alias("author"),
        F.col("c_mktsegment").alias("title"), (F.col("c_nationkey") + 1990).alias("year"),
    )
    records = harmonise.conform(harmonise.placeholder_records(customers))
    records = harmonise.with_constants(records, {"Source": "customer"})
    return harmonise.render_defaults(records, {c: "" for c in schemas.OUTPUT_COLUMNS})


@query(
    "proj_ids",
    """
SELECT * FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'OLD_' || o_orderkey ELSE
    'PROJ_' || lpad(CAST(row_number() OVER (ORDER BY o_orderkey) AS VARCHAR), 5, '0') END AS "ProjID",
    row_number() OVER (ORDER BY o_orderkey) AS row_no FROM orders)
WHERE row_no >= 101
""",
)
def proj_ids(t):
    known = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("OLD_"), "o_orderkey"))
    orders = t.orders.select("o_orderkey", known.alias("ProjID"))
    numbered = harmonise.with_row_numbers(orders, "o_orderkey", "row_no")
    named = numbered.withColumn("ProjID", F.coalesce("ProjID", harmonise.proj_id("row_no")))
    return harmonise.from_row(named, "row_no", 101)


@query(
    "proj_numbers",
    """
SELECT o_orderkey, 'PROJ_' || lpad(CAST(row_number() OVER (ORDER BY o_orderkey) AS VARCHAR), 5, '0') AS "ProjID" FROM orders
""",
)
def proj_numbers(t):
    return harmonise.with_proj_id(t.orders.select("o_orderkey"), "o_orderkey")


@query(
    "last_proj_number",
    "SELECT max(o_orderkey) AS last_number FROM orders",
)
def last_proj_number(t):
    return harmonise.last_proj_number(t.orders.select(harmonise.proj_id("o_orderkey").alias("ProjID")))


# --- joins ---------------------------------------------------------------------


@query(
    "attach_ids",
    """
SELECT c_custkey, n_name, n_regionkey FROM customer LEFT JOIN nation
ON c_nationkey + 5 = n_nationkey
""",
)
def attach_ids(t):
    customers = t.customer.withColumn("nation", F.col("c_nationkey") + 5)  # 25 and more miss
    return match.attach(customers, t.nation, "nation", "n_nationkey").select(
        "c_custkey", "n_name", "n_regionkey"
    )


@query(
    "left_fill",
    """
WITH f AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN CAST(month(o_orderdate) AS INTEGER) END AS month,
  CASE WHEN o_orderpriority = '5-LOW' THEN CAST(year(o_orderdate) AS INTEGER) END AS started FROM orders),
g AS (SELECT l_orderkey AS o_orderkey, l_suppkey AS o_custkey, CAST(min(month(l_shipdate)) AS INTEGER) AS month,
  CAST(min(year(l_shipdate)) AS INTEGER) AS started FROM lineitem GROUP BY ALL)
SELECT o_orderkey, o_custkey, coalesce(f.month, g.month) AS month, coalesce(f.started, g.started) AS started
FROM f LEFT JOIN g USING (o_orderkey, o_custkey)
""",
)
def left_fill(t):
    full = t.orders.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "F", F.month("o_orderdate")).alias("month"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.year("o_orderdate")).alias("started"),
    )
    other = t.lineitem.groupBy(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("o_custkey")
    ).agg(
        F.min(F.month("l_shipdate")).alias("month"), F.min(F.year("l_shipdate")).alias("started")
    )
    return match.fill_from(full, other, ["o_orderkey", "o_custkey"], ["month", "started"])


@query(
    "pending_keys",
    """
SELECT DISTINCT 'k' || o_orderkey AS doi FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
""",
)
def pending_keys(t):
    keys = t.orders.select(F.concat(F.lit(" K"), "o_orderkey").alias("doi"))
    done = t.lineitem.where(F.col("l_returnflag") == "A").select(
        F.concat(F.lit("k"), "l_orderkey", F.lit(" ")).alias("doi")
    )
    return match.pending(keys, done, "doi")


def landed_customers(t):
    """Customers as stored lookup responses, with failures of every kind."""
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    code = (
        F.when(seg == "BUILDING", 404).when(seg == "FURNITURE", 503)
        .when(seg == "MACHINERY", None).otherwise(200)
    )
    body = F.when(
        bal > 0, F.to_json(F.struct(F.concat(F.lit("https://openalex.org/W"), "c_custkey").alias("id")))
    ).otherwise("{broken")
    key = F.concat(F.lit("10.4/C"), "c_custkey").alias("key")
    first = t.customer.select(
        key, F.lit("openalex").alias("source"), code.alias("code"),
        F.when(seg == "AUTOMOBILE", body).when(seg == "HOUSEHOLD", body).alias("body"),
        F.when(seg == "MACHINERY", "timeout").alias("error"),
    )
    # Some were asked again: an empty and a cut-off answer, neither better than the first,
    # and an answer that knows no id.
    again = F.when(bal > 5000, None).when(bal > 2000, "{\"id\":").otherwise("{\"other\": 1}")
    second = t.customer.select(
        F.lower(key).alias("key"), F.lit("openalex").alias("source"), F.lit(200).alias("code"),
        again.alias("body"), F.lit(None).cast("string").alias("error"),
    )
    return first.unionByName(second)


_LOOKUP_SQL = """
WITH k AS (SELECT DISTINCT o_custkey + 50 AS k FROM orders),
-- each response on its own, as the lookup defines its outcome
r AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Exception' WHEN c_mktsegment = 'FURNITURE' THEN 'Error 503'
    WHEN c_mktsegment = 'BUILDING' THEN 'Not Found' WHEN c_acctbal > 0 THEN 'Found' ELSE 'Exception' END AS status,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 999 WHEN c_mktsegment = 'FURNITURE' THEN 503 WHEN c_mktsegment = 'BUILDING' THEN 404 ELSE 200 END AS code
  FROM customer
  UNION ALL
  SELECT c_custkey, CASE WHEN c_acctbal > 2000 THEN 'Exception' ELSE 'Not Found' END, 200 FROM customer),
-- an id before the news that there is none, before a failure
b AS (
  SELECT *, row_number() OVER (PARTITION BY c_custkey
    ORDER BY CASE status WHEN 'Found' THEN 0 WHEN 'Not Found' THEN 1 ELSE 2 END, code) AS place FROM r)
SELECT '10.4/c' || k AS doi, status, CASE WHEN status = 'Found' THEN 'https://openalex.org/W' || c_custkey END AS external_id
FROM k LEFT JOIN b ON c_custkey = k AND place = 1
"""


def looked_up(t):
    # The last keys are beyond those of the customers and have no response.
    keys = t.orders.select(F.concat(F.lit(" 10.4/c"), F.col("o_custkey") + 50).alias("doi"))
    return match.lookup_doi(keys, landed_customers(t), "doi", parse_json("body", "id string")["id"])


@query("lookup_doi", _LOOKUP_SQL)
def lookup_doi(t):
    return looked_up(t)


@query(
    "lookup_summary",
    f"""
WITH l AS ({_LOOKUP_SQL})
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'Found') AS found,
  count(*) FILTER (WHERE status IS DISTINCT FROM 'Found') AS not_found FROM l
""",
)
def lookup_summary(t):
    status = F.coalesce(F.col("status"), F.lit("")) == "Found"
    return frequency.count_where(looked_up(t), found=status, not_found=~status)


@query(
    "attach_metadata",
    f"""
WITH l AS ({_LOOKUP_SQL})
SELECT doi, external_id, c_name FROM l JOIN customer ON external_id = 'https://openalex.org/W' || c_custkey
WHERE status = 'Found'
""",
)
def attach_metadata(t):
    works = t.customer.select(
        F.concat(F.lit("https://openalex.org/W"), "c_custkey").alias("external_id"), "c_name"
    )
    found = looked_up(t).where(F.col("status") == "Found").select("doi", "external_id")
    return match.attach_metadata(found, works, "external_id")


LONG_TITLE = "wages and firms " * 40

_CASCADE_SQL = f"""
WITH r AS (SELECT o_orderkey, 'Study  of {LONG_TITLE}' || o_custkey AS title,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN 'Smith' ELSE 'Jones' END AS author,
  CASE WHEN o_orderstatus = 'F' THEN '10.5/' || o_custkey WHEN o_orderstatus = 'O' THEN '10.5/x' || o_custkey END AS doi FROM orders),
i AS (SELECT '10.5/' || CASE WHEN c_nationkey > 5 THEN c_custkey ELSE -c_custkey END AS doi, 'study of {LONG_TITLE}' || c_custkey AS title,
  CASE WHEN c_nationkey > 12 THEN 'jones' ELSE 'smith' END AS author, 'PMC' || c_custkey AS pmcid FROM customer),
m AS (SELECT o_orderkey, r.title, r.author, r.doi, d.pmcid AS p1, p.pmcid AS p2 FROM r
  LEFT JOIN i d ON r.doi = d.doi
  LEFT JOIN i p ON d.pmcid IS NULL AND lower(replace(r.title, '  ', ' ')) = p.title AND lower(r.author) = p.author)
SELECT o_orderkey AS "ProjID", title AS "Title", author AS "Author", doi AS "DOI",
  p1 IS NOT NULL OR p2 IS NOT NULL AS "In_PMC", coalesce(p1, p2) AS "PMCID",
  CASE WHEN p1 IS NOT NULL THEN 'DOI' WHEN p2 IS NOT NULL THEN 'Title/Author' END AS "Method",
  CASE WHEN p1 IS NOT NULL THEN 'Found by DOI' WHEN p2 IS NOT NULL THEN 'Found by title/author'
    WHEN author IS NULL THEN 'Missing title or author' ELSE 'Not found in PMC' END AS "Reason"
FROM m
"""


def cascade(t):
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    records = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Study  of "), F.lit(LONG_TITLE), "o_custkey").alias("title"),
        F.when(p == "5-LOW", None).when(p == "2-HIGH", "Smith; Doe").otherwise("Jones, A.").alias("author"),
        F.when(s == "F", F.concat(F.lit("10.5/"), "o_custkey"))
        .when(s == "O", F.concat(F.lit("10.5/x"), "o_custkey")).alias("doi"),
    )
    # Long titles that differ at the end only, and DOIs the records do not have.
    index = t.customer.select(
        F.concat(F.lit(" 10.5/"), F.when(F.col("c_nationkey") > 5, F.col("c_custkey")).otherwise(-F.col("c_custkey"))).alias("doi"),
        F.concat(F.lit("STUDY of "), F.lit(LONG_TITLE.upper()), "c_custkey").alias("title"),
        F.when(F.col("c_nationkey") > 12, "Jones").otherwise("Smith").alias("author"),
        F.concat(F.lit("PMC"), "c_custkey").alias("pmcid"),
    )
    return match.match_cascade(records, index)


@query("match_cascade", _CASCADE_SQL)
def match_cascade(t):
    return cascade(t)


@query(
    "match_summary",
    f'SELECT "In_PMC", "Method", "Reason", count(*) AS n FROM ({_CASCADE_SQL}) GROUP BY ALL',
)
def match_summary(t):
    return frequency.match_summary(cascade(t))


@query(
    "resolve_pi",
    """
WITH n AS (SELECT p_partkey, CASE WHEN p_size > 30 THEN upper(p_name) WHEN p_size > 15 THEN 'someone ' || string_split(p_name, ' ')[2]
  WHEN p_size > 5 THEN 'some one' ELSE string_split(p_name, ' ')[2] END AS name FROM part),
g AS (SELECT string_split(p_name, ' ')[1] AS given, string_split(p_name, ' ')[2] AS family, min(p_partkey) AS rank FROM part GROUP BY ALL),
f AS (SELECT family, min(rank) AS rank FROM g GROUP BY ALL)
SELECT p_partkey, 'id' || coalesce(g.rank, f.rank) AS orcid FROM n
LEFT JOIN g ON lower(name) = given || ' ' || g.family
LEFT JOIN f ON g.rank IS NULL AND contains(name, ' ') AND lower(string_split(name, ' ')[-1]) = f.family
""",
)
def resolve_pi(t):
    parts = F.split("p_name", " ")
    people = t.part.select(
        F.get(parts, F.lit(0)).alias("given"), F.get(parts, F.lit(1)).alias("family"),
        F.concat(F.lit("id"), "p_partkey").alias("orcid"), F.col("p_partkey").alias("rank"),
    )
    size = F.col("p_size")
    name = (
        F.when(size > 30, F.upper("p_name"))
        .when(size > 15, F.concat(F.lit("someone "), F.get(parts, F.lit(1))))
        .when(size > 5, "some one")
        .otherwise(F.get(parts, F.lit(1)))  # one word only
    )
    projects = t.part.select("p_partkey", name.alias("name"))
    return match.resolve_pi(projects, people, "name", "p_partkey").select("p_partkey", "orcid")


_CROSSREF_SQL = """
SELECT o_orderkey, c_mktsegment AS "OutputVenue", CASE WHEN c_nationkey > 3 THEN CAST(c_nationkey AS VARCHAR) END AS "OutputVolume",
  CASE WHEN c_nationkey > 9 THEN CAST(c_custkey AS VARCHAR) END AS "OutputNumber",
  CASE WHEN c_acctbal > 0 THEN '1-' || c_custkey END AS "OutputPages",
  CASE WHEN c_custkey IS NOT NULL AND c_acctbal > 5000 THEN '7' END AS "OutputMonth",
  'Doe, A, Roe, . ' || c_name || '. ' || c_mktsegment ||
  CASE WHEN c_nationkey > 3 THEN ' ' || c_nationkey || CASE WHEN c_nationkey > 9 THEN '(' || c_custkey || ')' ELSE '' END ELSE '' END ||
  CASE WHEN c_acctbal > 0 THEN ', 1-' || c_custkey ELSE '' END || ' (' || (1980 + c_nationkey) || ')' AS "OutputBiblio"
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND o_orderstatus <> 'P'
"""


@query("crossref_attach", _CROSSREF_SQL)
def crossref_attach(t):
    nation, bal = F.col("c_nationkey"), F.col("c_acctbal")

    def text_of(c):
        return F.col(c).cast("string")

    person = "struct<family:string,given:string>"
    body = F.to_json(
        F.struct(
            F.array("c_name").alias("title"),
            F.array("c_mktsegment").alias("container-title"),
            F.when(nation > 3, text_of("c_nationkey")).alias("volume"),
            F.when(nation > 9, text_of("c_custkey")).alias("issue"),
            F.when(bal > 0, F.concat(F.lit("1-"), "c_custkey")).alias("page"),
            F.array(
                F.struct(F.lit("Doe").alias("family"), F.lit("A").alias("given")).cast(person),
                F.struct(F.lit("Roe").alias("family"), F.lit(None).cast("string").alias("given")).cast(person),
            ).alias("author"),
            F.struct(
                F.array(F.when(bal > 5000, F.array(nation + 1980, F.lit(7))).otherwise(F.array(nation + 1980))).alias("date-parts")
            ).alias("published-print"),
            F.struct(F.array(F.array(nation + 1980)).alias("date-parts")).alias("published"),
        )
    )
    # Every DOI also has a message with gaps only and one that cannot be read.
    bodies = F.explode(F.array(body, F.lit("{}"), F.lit("{broken")))
    messages = t.customer.select(F.concat(F.lit("10.7/C"), "c_custkey").alias("key"), bodies.alias("body")).select(
        "key", parse_json("body", schemas.CROSSREF_MESSAGE).alias("msg")
    )
    doi = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("10.7/c"), "o_custkey"))
    records = t.orders.select("o_orderkey", doi.alias("doi"))
    return match.attach_crossref(records, messages, "doi", "o_orderkey").drop("doi")


# Orders of a customer as records of one output in many spellings: the i-th one shares its DOI
# with one neighbour and its title with the other, so that all are one by a chain, unless a
# DOI is missing or a title is another's.
_CHAIN_SQL = """
WITH o AS (SELECT o_orderkey AS id, o_custkey, o_orderpriority, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders),
r AS (SELECT id, o_custkey, i, CASE WHEN o_orderstatus <> 'F' OR i % 4 < 2 THEN '10.7/' || o_custkey || '.' || i // 2 END AS doi,
  'Report ' || o_custkey || ' no ' || (i + 1) // 2 AS title, CASE WHEN o_orderpriority <> '5-LOW' THEN 'a' || o_custkey END AS author,
  o_orderpriority AS status FROM o),
l AS (SELECT *, lag(doi) OVER w AS d, lag(author) OVER w AS a FROM r WINDOW w AS (PARTITION BY o_custkey ORDER BY i)),
g AS (SELECT *, sum(CASE WHEN i % 2 = 1 AND doi = d OR i % 2 = 0 AND i > 0 AND author = a THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey ORDER BY i) AS part FROM l),
m AS (SELECT *, (doi IS NULL)::INT + (author IS NULL)::INT AS missing FROM g)
SELECT min(id) AS id, arg_min(doi, missing * 1000000000000 + id) FILTER (WHERE doi IS NOT NULL) AS doi,
  arg_min(title, missing * 1000000000000 + id) AS title, arg_min(author, missing * 1000000000000 + id) FILTER (WHERE author IS NOT NULL) AS author,
  arg_min(status, missing * 1000000000000 + id) AS status, count(*) AS n_records
FROM m GROUP BY o_custkey, part
"""


@query("merged_entities", _CHAIN_SQL)
def merged_entities(t):
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    orders = t.orders.withColumn("i", place)
    i, customer = F.col("i"), F.col("o_custkey")
    number = F.concat(F.lit("10.7/"), customer, F.lit("."), F.floor(i / 2))
    spelled = F.when(i % 3 == 1, F.concat(F.lit(" "), number)).otherwise(number)
    title = F.concat(F.lit("Report "), customer, F.lit(" no "), F.floor((i + 1) / 2))
    rows = orders.select(
        F.col("o_orderkey").alias("id"),
        F.when((F.col("o_orderstatus") != "F") | (i % 4 < 2), spelled).alias("doi"),
        F.when(i % 2 == 0, F.upper(title)).otherwise(title).alias("title"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("a"), customer)).alias("author"),
        F.col("o_orderpriority").alias("status"),
    )
    merged = entities.merge(rows, "id", entities.identity_keys())
    return merged.withColumns({"doi": F.trim("doi"), "title": F.replace(F.replace(F.lower("title"), F.lit("report"), F.lit("Report")), F.lit(" NO "), F.lit(" no "))})


_TITLE_SEARCH_SQL = """
WITH p AS (SELECT p_partkey, p_brand, p_size, string_split(lower(p_name || ' ' || p_type || ' n' || p_size || ' k' || p_partkey % 40), ' ') AS t FROM part),
q AS (SELECT p_partkey, p_brand, list_sort(list_distinct(t)) AS w FROM p),
x AS (SELECT p_partkey, p_brand, list_sort(list_distinct(t[CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END:])) AS w FROM p WHERE p_size % 3 <> 0),
s AS (SELECT q.p_partkey, x.p_partkey AS found, len(list_intersect(q.w, x.w)) AS c, len(q.w) AS a, len(x.w) AS b
  FROM q JOIN x ON q.p_brand = x.p_brand)
SELECT q.p_partkey, b.found, b.share FROM q LEFT JOIN (
  SELECT p_partkey, found, c / (a + b - c) AS share FROM s WHERE c >= 0.8 * (a + b - c) - 1e-9
  QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY c / (a + b - c) DESC, found) = 1) b ON b.p_partkey = q.p_partkey
"""


@query("title_search", _TITLE_SEARCH_SQL)
def title_search(t):
    """Parts looked up in a list where names have their words turned round and some lack a word."""
    title = F.concat_ws(" ", "p_name", "p_type", F.concat(F.lit("n"), "p_size"), F.concat(F.lit("k"), F.col("p_partkey") % 40))
    words = F.split(title, " ")
    left_out = F.slice(words, F.when(F.col("p_size") % 2 == 0, 2).otherwise(1), F.size(words))
    listed = t.part.where(F.col("p_size") % 3 != 0).select(
        F.array_join(F.reverse(left_out), ",  ").alias("title"), "p_brand", F.col("p_partkey").alias("found")
    )
    asked = t.part.select("p_partkey", F.upper(title).alias("title"), "p_brand")
    return search.with_match(asked, listed, F.col("p_brand"), "found").select("p_partkey", "found", "share")
