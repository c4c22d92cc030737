"""Counts, pivots, profiles, windows and life-cycle statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from scholarweave.functions.predicates import is_present
from scholarweave.operators import frequency, harmonise, lifecycle, ordered
from scholarweave.plans.registry import query

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_TYPES = ["click", "purchase", "signup", "view"]
YEARS = range(1995, 2002)


def order_years(t):
    """Orders as outputs: year of the order and its priority as topic."""
    return t.orders.select(
        F.year("o_orderdate").alias("OutputYear"), F.col("o_orderpriority").alias("PredictedTopic")
    )


def order_pairs(t, since: int | None = 1990):
    df = order_years(t)
    year = harmonise.resolve_column(df, ("Year", "OutputYear"))
    topic = harmonise.resolve_column(df, ("Topic", "PredictedTopic"))
    return frequency.usable_years(df, year, topic, since)


def brand_pairs(t):
    """Line items as outputs: ship year and the brand of the part."""
    lines = t.lineitem.select("l_partkey", F.year("l_shipdate").alias("year"))
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("topic"))
    return lines.join(brands, "l_partkey").select("year", "topic")


_YEAR_TOPIC = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS topic, count(*) AS n
FROM orders WHERE year(o_orderdate) >= 1990 AND o_orderpriority IS NOT NULL GROUP BY ALL
"""


@query("outputs_by_year_category", _YEAR_TOPIC)
def outputs_by_year_category(t):
    return frequency.year_topic_counts(order_pairs(t))


@query(
    "pivot_year_category",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, "
    + ", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + " FROM orders WHERE o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1",
)
def pivot_year_category(t):
    return frequency.year_by_topic(order_pairs(t, None), PRIORITIES)


@query(
    "pivot_category_year",
    "SELECT o_orderpriority AS topic, "
    + ", ".join(
        f"count(*) FILTER (WHERE year(o_orderdate) = {y}) AS y{y}" for y in YEARS
    )
    + " FROM orders WHERE year(o_orderdate) >= 1990 AND o_orderpriority IS NOT NULL GROUP BY 1",
)
def pivot_category_year(t):
    return frequency.topic_by_year(order_pairs(t), YEARS)


@query(
    "matrix_totals",
    f"""
WITH c AS ({_YEAR_TOPIC})
SELECT 'topic' AS axis, topic AS value, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY topic
UNION ALL
SELECT 'year', CAST(year AS VARCHAR), CAST(sum(n) AS BIGINT) FROM c GROUP BY year
""",
)
def matrix_totals(t):
    return frequency.matrix_totals(frequency.year_topic_counts(order_pairs(t)))


@query(
    "matrix_shape",
    f"""
WITH c AS ({_YEAR_TOPIC})
SELECT count(DISTINCT topic) AS topics, count(DISTINCT year) AS years,
       min(year) AS first_year, max(year) AS last_year FROM c
""",
)
def matrix_shape(t):
    return frequency.matrix_shape(frequency.year_topic_counts(order_pairs(t)))


@query(
    "value_counts",
    "SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source",
)
def value_counts(t):
    return frequency.value_counts(t.documents, "source")


@query(
    "top_n_keys",
    """
SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL
GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10
""",
)
def top_n_keys(t):
    return frequency.top_n(t.part, "p_brand", 10)


@query(
    "prolific_authors",
    """
SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IS NOT NULL
GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 10
""",
)
def prolific_authors(t):
    return frequency.top_n(t.lineitem, "l_suppkey", 10)


@query(
    "crosstab",
    "SELECT user_id, "
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS \"{e}\"" for e in EVENT_TYPES)
    + ", count(*) FILTER (WHERE event_type IS NULL OR event_type = 'error') AS missing"
    " FROM events GROUP BY user_id",
)
def crosstab(t):
    events = t.events.select("user_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return frequency.crosstab(events, "user_id", "kind", EVENT_TYPES)


BY_YEAR_SQL = (
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders "
    "WHERE o_orderdate IS NOT NULL GROUP BY 1"
)


def yearly_outputs(t):
    return frequency.outputs_by_year(order_years(t), "OutputYear")


@query("outputs_by_year", BY_YEAR_SQL)
def outputs_by_year(t):
    return yearly_outputs(t)


@query(
    "peak_year",
    f"""
WITH s AS ({BY_YEAR_SQL})
SELECT (SELECT year FROM s ORDER BY n DESC, year LIMIT 1) AS peak_year,
       (SELECT max(n) FROM s) AS peak_value,
       (SELECT n FROM s ORDER BY year DESC LIMIT 1) AS current_value
""",
)
def peak_year(t):
    return frequency.peak(yearly_outputs(t))


@query(
    "trajectory",
    f"""
WITH s AS ({BY_YEAR_SQL})
SELECT year, n, lag(year) OVER (ORDER BY year) AS from_year,
       lag(n) OVER (ORDER BY year) AS from_value FROM s
""",
)
def trajectory(t):
    return ordered.trajectory(yearly_outputs(t), "n")


def order_spans(t):
    """Orders as projects: order year, first and last ship year of their lines."""
    ships = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.year("l_shipdate")).alias("ProjectYearEnded"),
        F.min(F.year("l_shipdate")).alias("OutputYear"),
    )
    starts = t.orders.select("o_orderkey", F.year("o_orderdate").alias("ProjectYearStarted"))
    return starts.join(ships, "o_orderkey")


_SPANS = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS s, CAST(e AS INTEGER) AS e, CAST(f AS INTEGER) AS f
FROM orders JOIN (
  SELECT l_orderkey, max(year(l_shipdate)) AS e, min(year(l_shipdate)) AS f
  FROM lineitem GROUP BY l_orderkey
) ON o_orderkey = l_orderkey
"""


@query(
    "active_by_period",
    f"""
WITH p AS ({_SPANS}), v AS (SELECT s, e FROM p WHERE s <= e),
spine AS (
  SELECT CAST(unnest(generate_series((SELECT min(s) FROM v), (SELECT max(e) FROM v))) AS INTEGER) AS year
)
SELECT year, count(v.s) AS n FROM spine LEFT JOIN v ON year BETWEEN s AND e GROUP BY year
""",
)
def active_by_period(t):
    return frequency.active_by_year(order_spans(t), "ProjectYearStarted", "ProjectYearEnded")


_LIFECYCLE = f"""
SELECT o_orderkey, e - s AS duration, f - s AS time_to_publish
FROM ({_SPANS}) WHERE e - s >= 0 AND f - s >= 0
"""


def lifecycles(t):
    return lifecycle.with_lifecycle(
        order_spans(t), "ProjectYearStarted", "ProjectYearEnded", "OutputYear"
    ).select("o_orderkey", "duration", "time_to_publish")


@query(
    "lifecycle_features",
    f"""
WITH l AS ({_LIFECYCLE}),
m AS (SELECT avg(duration) AS ad, stddev_pop(duration) AS sd,
             avg(time_to_publish) AS ap, stddev_pop(time_to_publish) AS sp FROM l)
SELECT o_orderkey, round((duration - ad) / sd, 6) AS duration,
       round((time_to_publish - ap) / sp, 6) AS time_to_publish
FROM l, m
""",
)
def lifecycle_features(t):
    scaled = lifecycle.standardise(lifecycles(t), lifecycle.FEATURES)
    return scaled.select("o_orderkey", *[F.round(c, 6).alias(c) for c in lifecycle.FEATURES])


# Assignment and mean steps on the distinct weighted points, from the two points that are
# furthest apart along the sum of both scores, repeated until they no longer change anything.
_SQUARE = "(p.x - {0}x) * (p.x - {0}x) + (p.y - {0}y) * (p.y - {0}y)"
_NEAR = f"{_SQUARE.format('u')} <= {_SQUARE.format('v')}"


def _mean(column: str, members: str) -> str:
    chosen = f"list_filter(pts, lambda p: {members})"
    return (
        f"list_sum(list_transform({chosen}, lambda p: p.w * p.{column})) / list_sum(list_transform({chosen}, lambda p: p.w))"
    )


@query(
    "lifecycle_clusters",
    f"""
WITH RECURSIVE l AS MATERIALIZED ({_LIFECYCLE}),
m AS (SELECT avg(duration) AS ad, stddev_pop(duration) AS sd, avg(time_to_publish) AS ap, stddev_pop(time_to_publish) AS sp FROM l),
g AS (SELECT duration, time_to_publish, (duration - ad) / sd AS x, (time_to_publish - ap) / sp AS y, count(*) AS w FROM l, m GROUP BY ALL),
pts AS (SELECT list({{'x': x, 'y': y, 'w': w}} ORDER BY x + y, x) AS pts FROM g),
s(i, ux, uy, vx, vy, pts) AS (
  SELECT 0, pts[1].x, pts[1].y, pts[-1].x, pts[-1].y, pts FROM pts
  UNION ALL
  SELECT i + 1, {_mean('x', _NEAR)}, {_mean('y', _NEAR)}, {_mean('x', f'NOT ({_NEAR})')}, {_mean('y', f'NOT ({_NEAR})')}, pts
  FROM s WHERE i < 200),
c AS (SELECT least([ux, uy], [vx, vy]) AS a, greatest([ux, uy], [vx, vy]) AS b FROM s ORDER BY i DESC LIMIT 1),
k AS (
  SELECT duration, time_to_publish,
    CASE WHEN (x - a[1]) ** 2 + (y - a[2]) ** 2 <= (x - b[1]) ** 2 + (y - b[2]) ** 2 THEN 0 ELSE 1 END AS lifecycle_cluster
  FROM g, c)
SELECT o_orderkey, duration, time_to_publish, lifecycle_cluster FROM l JOIN k USING (duration, time_to_publish)
""",
)
def lifecycle_clusters(t):
    return lifecycle.lifecycle_clusters(lifecycles(t))


# Eigenvectors of the covariance matrix (25 numbers, row by row): squaring it 50 times leaves
# the product of the leading vector with itself, which is then taken off the matrix.
_T = len(PRIORITIES)
_PCA_SQL = f"""
WITH RECURSIVE w AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {', '.join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS t{i}" for i, p in enumerate(PRIORITIES))}
  FROM orders WHERE o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1),
z AS MATERIALIZED (SELECT year, [{', '.join(f"(t{i} - avg(t{i}) OVER ()) / stddev_pop(t{i}) OVER ()" for i in range(_T))}] AS z FROM w),
cov AS (SELECT [{', '.join(f"sum(z[{i + 1}] * z[{j + 1}]) / (count(*) - 1)" for i in range(_T) for j in range(_T))}] AS a FROM z),
r(k, step, a, p, v, vectors, sizes) AS (
  SELECT 1, 0, a, a, CAST([] AS DOUBLE[]), CAST([] AS DOUBLE[][]), CAST([] AS DOUBLE[]) FROM cov
  UNION ALL
  SELECT CASE WHEN step = 51 THEN k + 1 ELSE k END, CASE WHEN step = 51 THEN 0 ELSE step + 1 END,
    CASE WHEN step = 51 THEN rest ELSE a END,
    CASE WHEN step = 51 THEN rest WHEN step = 50 THEN p ELSE list_transform(square, lambda x: x / trace) END,
    CASE WHEN step = 50 THEN lead ELSE v END,
    CASE WHEN step = 51 THEN list_append(vectors, v) ELSE vectors END,
    CASE WHEN step = 51 THEN list_append(sizes, size) ELSE sizes END
  FROM (
    SELECT *, list_transform(range({_T * _T}), lambda x: a[x + 1] - size * v[x // {_T} + 1] * v[x % {_T} + 1]) AS rest,
      {' + '.join(f"square[{i * _T + i + 1}]" for i in range(_T))} AS trace
    FROM (
      SELECT *, [{', '.join(' + '.join(f"p[{i * _T + l + 1}] * p[{l * _T + j + 1}]" for l in range(_T)) for i in range(_T) for j in range(_T))}] AS square,
        list_transform(range({_T}), lambda i: p[i * {_T} + top] / sqrt(p[(top - 1) * {_T} + top])) AS lead,
        list_sum(list_transform(range({_T * _T}), lambda x: a[x + 1] * v[x // {_T} + 1] * v[x % {_T} + 1])) AS size
      FROM (
        SELECT *, list_position(diagonal, list_max(diagonal)) AS top
        FROM (SELECT *, [{', '.join(f"p[{i * _T + i + 1}]" for i in range(_T))}] AS diagonal FROM r WHERE k <= {_T}))))),
e AS (SELECT vectors, sizes FROM r ORDER BY k DESC, step LIMIT 1)
"""


@query(
    "topic_pca",
    _PCA_SQL
    + ", s AS (SELECT list_transform(vectors, lambda v: list_transform(v, lambda x: "
    "x * sign(v[list_position(list_transform(v, lambda y: abs(y)), list_max(list_transform(v, lambda y: abs(y))))]))) AS vectors FROM e) "
    + "SELECT year, "
    + ", ".join(
        "round(" + " + ".join(f"z[{i + 1}] * vectors[{k}][{i + 1}]" for i in range(_T)) + f", 6) + 0.0 AS PC{k}"
        for k in range(1, _T + 1)
    )
    + " FROM z, s",
)
def topic_pca(t):
    scores = lifecycle.topic_pca(frequency.year_by_topic(order_pairs(t, None), PRIORITIES))
    return scores.select("year", *[(F.round(c, 6) + 0.0).alias(c) for c in scores.columns if c != "year"])


@query(
    "explained_variance",
    _PCA_SQL
    + f"""
SELECT CAST(i AS INTEGER) AS component, round(sizes[i] / list_sum(sizes), 6) AS share,
  round(list_sum(sizes[1:i]) / list_sum(sizes), 6) AS running_share
FROM e, range(1, {_T + 1}) AS n(i)
""",
)
def explained_variance(t):
    shares = lifecycle.explained_variance(frequency.year_by_topic(order_pairs(t, None), PRIORITIES))
    return shares.select("component", *[F.round(c, 6).alias(c) for c in ("share", "running_share")])


@query(
    "compact_view",
    """
WITH c AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, p_brand AS topic, count(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
), top AS (
  SELECT topic FROM c GROUP BY topic ORDER BY sum(n) DESC, topic LIMIT 10
), recent AS (SELECT DISTINCT year FROM c ORDER BY year DESC LIMIT 5)
SELECT year, topic, n FROM c WHERE topic IN (FROM top) AND year IN (FROM recent)
""",
)
def compact_view(t):
    pairs = frequency.usable_years(brand_pairs(t), "year", "topic")
    return ordered.compact_view(frequency.year_topic_counts(pairs)).select("year", "topic", "n")


@query(
    "sample_n",
    """
SELECT p_partkey, p_name FROM part
ORDER BY md5('42:' || p_partkey), p_partkey LIMIT 150
""",
)
def sample_n(t):
    return ordered.sample_n(t.part.select("p_partkey", "p_name"), "p_partkey")


@query(
    "best_per_key",
    """
SELECT l_orderkey, l_partkey, l_linenumber FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_returnflag DESC, l_linenumber, l_partkey, l_suppkey) AS r
  FROM lineitem) WHERE r = 1
""",
)
def best_per_key(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
        (-F.ascii("l_returnflag")).alias("flag"),
    )
    order = F.struct("flag", "l_linenumber", "l_partkey", "l_suppkey")
    return ordered.best_per_key(lines, "l_orderkey", order, ["l_partkey", "l_linenumber"])


@query(
    "limit_per_key",
    """
SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber, CAST(r AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber) AS r
  FROM lineitem) WHERE r <= 20
""",
)
def limit_per_key(t):
    lines = t.lineitem.select(
        "l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"
    )
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_partkey", "l_linenumber"]
    return ordered.limit_per_key(lines, "l_suppkey", order, 20).drop("l_extendedprice")


def line_records(t):
    """Line items as output records in which any field may be missing or blank."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") != "R", F.concat(F.lit("Line "), "l_partkey")).alias("OutputTitle"),
        F.when(F.col("l_discount") > 0.02, F.concat(F.lit("10.1/"), "l_orderkey")).alias("DOI"),
        F.when(F.col("l_linestatus") == "O", F.lit("  "))
        .otherwise(F.concat(F.lit("Venue "), "l_suppkey")).alias("OutputVenue"),
        F.when(F.col("l_tax") > 0.01, F.year("l_shipdate").cast("string")).alias("OutputYear"),
    )


LINE_RECORDS_SQL = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'R' THEN 'Line ' || l_partkey END AS "OutputTitle",
  CASE WHEN l_discount > 0.02 THEN '10.1/' || l_orderkey END AS "DOI",
  CASE WHEN l_linestatus = 'O' THEN '  ' ELSE 'Venue ' || l_suppkey END AS "OutputVenue",
  CASE WHEN l_tax > 0.01 THEN CAST(year(l_shipdate) AS VARCHAR) END AS "OutputYear"
FROM lineitem
"""
FUNNEL_COLUMNS = ["OutputTitle", "DOI", "OutputVenue", "OutputYear"]


def _funnel_sql() -> str:
    steps, passed = ["SELECT 0 AS step, 'all rows' AS after, count(*) AS n FROM r"], "true"
    for i, c in enumerate(FUNNEL_COLUMNS, start=1):
        passed += f" AND trim(coalesce(\"{c}\", '')) <> ''"
        steps.append(f"SELECT {i}, '{c}', count(*) FILTER (WHERE {passed}) FROM r")
    return f"WITH r AS ({LINE_RECORDS_SQL}) " + " UNION ALL ".join(steps)


@query("validity_funnel", _funnel_sql())
def validity_funnel(t):
    return frequency.funnel_counts(line_records(t), FUNNEL_COLUMNS)


@query(
    "valid_records",
    f"WITH r AS ({LINE_RECORDS_SQL}) SELECT * FROM r WHERE "
    + " AND ".join(f"trim(coalesce(\"{c}\", '')) <> ''" for c in FUNNEL_COLUMNS),
)
def valid_records(t):
    return frequency.funnel_rows(line_records(t), FUNNEL_COLUMNS)


@query(
    "present_counts",
    f"WITH r AS ({LINE_RECORDS_SQL}) SELECT count(*) AS total, "
    + ", ".join(
        f"count(*) FILTER (WHERE trim(coalesce(\"{c}\", '')) <> '') AS with_{c.lower()}"
        for c in FUNNEL_COLUMNS
    )
    + " FROM r",
)
def present_counts(t):
    return frequency.count_where(
        line_records(t), **{f"with_{c.lower()}": is_present(c) for c in FUNNEL_COLUMNS}
    )


@query(
    "profile_year_columns",
    """
WITH p AS (SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate) AS order_year FROM orders),
r AS (
  SELECT 'o_orderkey' AS "column", CAST(min(o_orderkey) AS DOUBLE) AS low, CAST(max(o_orderkey) AS DOUBLE) AS high FROM p
  UNION ALL SELECT 'o_custkey', min(o_custkey), max(o_custkey) FROM p
  UNION ALL SELECT 'o_totalprice', min(o_totalprice), max(o_totalprice) FROM p
  UNION ALL SELECT 'order_year', min(order_year), max(order_year) FROM p)
SELECT * FROM r WHERE low >= 1900 AND high <= 2030
""",
)
def profile_year_columns(t):
    orders = t.orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("order_year")
    )
    return frequency.year_column_profile(orders)


@query(
    "distinct_keys",
    "SELECT DISTINCT user_id, event_type FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL",
)
def distinct_keys(t):
    return t.events.select("user_id", "event_type").na.drop().distinct()
