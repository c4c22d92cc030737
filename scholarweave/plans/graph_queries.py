"""The graph of publications that share keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from scholarweave.operators import communities as grouping, graph
from scholarweave.plans.registry import query
from scholarweave.workspace import materialise


def part_publications(t):
    """Parts as publications, the words of their names as keywords."""
    return graph.publications(t.part, "p_partkey", F.split("p_name", " "))


_PART_WORDS = "SELECT DISTINCT p_partkey AS id, unnest(string_split(p_name, ' ')) AS keyword FROM part"


def _pairs(members: str) -> str:
    return f"""
SELECT DISTINCT a.id AS src, b.id AS dst FROM ({members}) a JOIN ({members}) b
ON a.keyword = b.keyword AND a.id < b.id
"""


@query(
    "shared_keyword_edges",
    _pairs(
        _PART_WORDS.replace(
            "FROM part", "FROM (SELECT * FROM part ORDER BY md5('42:' || p_partkey), p_partkey LIMIT 150)"
        )
    ),
)
def shared_keyword_edges(t):
    return graph.sampled_edges(part_publications(t))


@query(
    "sample_degrees",
    f"""
WITH v AS (SELECT p_partkey AS id, p_name FROM part ORDER BY md5('42:' || p_partkey), p_partkey LIMIT 150),
w AS (SELECT DISTINCT id, unnest(string_split(p_name, ' ')) AS keyword FROM v),
e AS (SELECT DISTINCT a.id AS src, b.id AS dst FROM w a JOIN w b ON a.keyword = b.keyword AND a.id < b.id),
d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id)
SELECT id, coalesce(degree, 0) AS degree FROM v LEFT JOIN d USING (id)
""",
)
def sample_degrees(t):
    sample = graph.sample_n(part_publications(t), "id")
    return graph.edge_degrees(sample, graph.sampled_edges(part_publications(t)))


@query(
    "keyword_groups",
    f"""
SELECT keyword, count(*) AS publications, count(*) * (count(*) - 1) // 2 AS pairs
FROM ({_PART_WORDS}) WHERE keyword <> '' GROUP BY keyword
""",
)
def keyword_groups(t):
    return graph.keyword_groups(graph.memberships(part_publications(t)))


_PART_DEGREES = f"""
SELECT p_partkey AS id, coalesce(degree, 0) AS degree FROM part LEFT JOIN (
  SELECT id, count(*) AS degree FROM (
    WITH e AS ({_pairs(_PART_WORDS)}) SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id
) ON id = p_partkey
"""


@query("degrees", _PART_DEGREES)
def degrees(t):
    return graph.degrees(part_publications(t))


_STATS = """
SELECT count(*) AS publications, CAST(sum(degree) // 2 AS BIGINT) AS edges,
  round(avg(degree), 6) AS mean_degree, max(degree) AS max_degree FROM ({})
"""


@query("degree_stats", _STATS.format(_PART_DEGREES))
def degree_stats(t):
    stats = graph.degree_stats(part_publications(t))
    return stats.withColumn("mean_degree", F.round("mean_degree", 6))


def document_publications(t):
    """Documents as publications, their lines as keywords: copies share lines."""
    return graph.publications(t.documents, "doc_id", F.split("text", "\n"))


_DOC_LINES = """
SELECT DISTINCT doc_id AS id, line AS keyword FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> ''
"""
_DOC_DEGREES = f"""
SELECT doc_id AS id, coalesce(degree, 0) AS degree FROM documents LEFT JOIN (
  SELECT id, count(*) AS degree FROM (
    WITH e AS ({_pairs(_DOC_LINES)}) SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id
) ON id = doc_id
"""


@query("copy_degree_stats", _STATS.format(_DOC_DEGREES))
def copy_degree_stats(t):
    stats = graph.degree_stats(document_publications(t))
    return stats.withColumn("mean_degree", F.round("mean_degree", 6))


@query(
    "components",
    f"""
WITH RECURSIVE m AS MATERIALIZED ({_DOC_LINES}),
e AS MATERIALIZED (SELECT DISTINCT a.id AS a, b.id AS b FROM m a JOIN m b USING (keyword) WHERE a.id <> b.id),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id WHERE r.root < e.b)
SELECT id, min(root) AS component FROM r GROUP BY id
""",
)
def components(t):
    return graph.components(document_publications(t))


@query(
    "bfs_levels",
    f"""
WITH RECURSIVE m AS MATERIALIZED ({_DOC_LINES}),
e AS MATERIALIZED (SELECT DISTINCT a.id AS a, b.id AS b FROM m a JOIN m b USING (keyword) WHERE a.id <> b.id),
r(id, level) AS (SELECT min(doc_id), 0 FROM documents GROUP BY source UNION SELECT e.b, r.level + 1 FROM r JOIN e ON e.a = r.id WHERE r.level < 8)
SELECT id, min(level) AS level FROM r GROUP BY id
""",
)
def bfs_levels(t):
    members = graph.shared_memberships(document_publications(t))
    seeds = t.documents.groupBy("source").agg(F.min("doc_id").alias("id")).select("id")
    return graph.bfs_levels(members, seeds)


@query(
    "part_bfs_levels",
    f"""
WITH m AS ({_PART_WORDS}),
h1 AS (SELECT DISTINCT b.id FROM m a JOIN m b USING (keyword) WHERE a.id = 0),
h2 AS (SELECT DISTINCT b.id FROM m a JOIN m b USING (keyword) WHERE a.id IN (FROM h1))
SELECT id, min(level) AS level FROM (SELECT 0 AS id, 0 AS level UNION ALL SELECT id, 1 FROM h1 UNION ALL SELECT id, 2 FROM h2) GROUP BY id
""",
)
def part_bfs_levels(t):
    members = materialise(graph.memberships(part_publications(t)), "members")
    seeds = t.part.agg(F.min("p_partkey").alias("id"))
    return graph.bfs_levels(members, seeds, max_hops=2)


def _communities(vertices: str, members: str) -> str:
    """The rounds as a recursive query: keywords choose, publications choose, else pairs merge."""
    return f"""
WITH RECURSIVE e AS MATERIALIZED ({members}),
m AS MATERIALIZED (SELECT count(*)::HUGEINT AS m FROM e),
kd AS MATERIALIZED (SELECT id, keyword, count(*) OVER (PARTITION BY id) AS k, count(*) OVER (PARTITION BY keyword) AS d FROM e),
r(round, id, label) AS (
  SELECT DISTINCT 0, id, id FROM e
  UNION ALL (
  WITH now AS MATERIALIZED (SELECT * FROM r),
  l AS MATERIALIZED (SELECT kd.*, label FROM kd JOIN now USING (id)),
  sk AS MATERIALIZED (SELECT label, count(*) AS size FROM l GROUP BY label),
  w AS MATERIALIZED (
    SELECT keyword, d, label AS h FROM (
      SELECT keyword, label, any_value(d) AS d, count(*) * any_value(m) - any_value(d)::HUGEINT * any_value(size) AS gain
      FROM l JOIN sk USING (label), m GROUP BY keyword, label)
    WHERE gain >= 0 QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY gain DESC, label) = 1),
  sd AS MATERIALIZED (SELECT h, sum(d) AS size FROM w GROUP BY h),
  c AS MATERIALIZED (
    SELECT id, h FROM (
      SELECT id, h, any_value(label) AS label, count(*) * any_value(m) - any_value(k)::HUGEINT * any_value(size) AS gain
      FROM l JOIN w USING (keyword) JOIN sd USING (h), m GROUP BY id, h)
    WHERE gain >= 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY gain DESC, (label = h) IS TRUE DESC, h) = 1),
  chosen AS MATERIALIZED (SELECT round, id, label, h FROM now LEFT JOIN c USING (id)),
  settled AS MATERIALIZED (SELECT bool_and(label IS NOT DISTINCT FROM h) AS yes FROM chosen),
  p AS MATERIALIZED (
    SELECT a, b, n * (SELECT m FROM m) - ka * db - kb * da AS gain FROM (
      SELECT a, b, n, coalesce(x.size, 0)::HUGEINT AS ka, coalesce(y.size, 0)::HUGEINT AS kb,
        coalesce(u.size, 0)::HUGEINT AS da, coalesce(v.size, 0)::HUGEINT AS db
      FROM (SELECT least(label, h) AS a, greatest(label, h) AS b, count(*) AS n FROM l JOIN w USING (keyword) WHERE label <> h GROUP BY a, b)
      LEFT JOIN sk x ON x.label = a LEFT JOIN sk y ON y.label = b LEFT JOIN sd u ON u.h = a LEFT JOIN sd v ON v.h = b)),
  best AS MATERIALIZED (
    SELECT x, a + b - x AS y, a, b, gain FROM (SELECT unnest([a, b]) AS x, a, b, gain FROM p WHERE gain > 0)
    QUALIFY row_number() OVER (PARTITION BY x ORDER BY gain DESC, a, b) = 1),
  liked AS MATERIALIZED (SELECT y AS x, count(*) AS liked FROM best GROUP BY y),
  roots AS MATERIALIZED (
    SELECT x AS root, y AS mate FROM best JOIN liked USING (x)
    QUALIFY count(*) OVER (PARTITION BY a, b) = 2 AND row_number() OVER (PARTITION BY a, b ORDER BY liked DESC, x) = 1),
  leaves AS MATERIALIZED (
    SELECT x, root, mate, gain, coalesce(sk.size, 0)::HUGEINT AS k, coalesce(sd.size, 0)::HUGEINT AS d
    FROM best JOIN roots ON y = root LEFT JOIN sk ON sk.label = x LEFT JOIN sd ON sd.h = x),
  fits AS MATERIALIZED (SELECT x, root, mate, gain > k * (sum(d) OVER (PARTITION BY root) - d) AS ok FROM leaves),
  g AS MATERIALIZED (
    SELECT x AS label, root AS goal FROM fits QUALIFY ok OR (x = mate AND NOT bool_or(ok) OVER (PARTITION BY root)))
  SELECT round + 1, id, CASE WHEN (SELECT yes FROM settled) THEN coalesce(goal, h) ELSE h END
  FROM chosen LEFT JOIN g ON g.label = chosen.h
  WHERE NOT (SELECT yes FROM settled) OR EXISTS (FROM g))),
f AS (SELECT id, label FROM r WHERE round = (SELECT max(round) FROM r)),
n AS (SELECT label, min(id) AS community FROM f WHERE label IS NOT NULL GROUP BY label)
SELECT v.id, coalesce(community, v.id) AS community FROM ({vertices}) v LEFT JOIN f USING (id) LEFT JOIN n USING (label)
"""


@query("communities", _communities("SELECT doc_id AS id FROM documents", _DOC_LINES))
def communities(t):
    return grouping.communities(document_publications(t))
