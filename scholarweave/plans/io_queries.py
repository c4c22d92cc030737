"""Round trips through sinks, and incremental runs. Outputs go to a fresh folder each time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from scholarweave.operators import counts, frequency, harmonise, numbering
from scholarweave.plans.count_queries import (
    BY_YEAR_SQL, FUNNEL_COLUMNS, LINE_RECORDS_SQL, YEARS, line_records, order_pairs, yearly_outputs,
)
from scholarweave.plans.match_queries import HARMONISED_SQL, group_frames
from scholarweave.plans.registry import query
from scholarweave.sources import tables
from scholarweave.sources.stored import KeyedTable
from scholarweave.streaming import incremental
from scholarweave.workspace import scratch_path


@query(
    "csv_roundtrip",
    f"""
WITH r AS ({LINE_RECORDS_SQL})
SELECT count(*) AS "rows", """
    + ", ".join(f"count(*) FILTER (WHERE trim(coalesce(\"{c}\", '')) <> '') AS \"{c}\"" for c in FUNNEL_COLUMNS)
    + " FROM r",
)
def csv_roundtrip(t):
    path = scratch_path(t.spark, "csv")
    rows = line_records(t)
    tables.write_csv(rows, path)
    back = tables.read_csv(t.spark, path, rows.schema, one_line=True)
    return tables.present_counts(back, FUNNEL_COLUMNS)


@query(
    "csv_quoting",
    """
SELECT doc_id, md5(text) AS digest, lang FROM documents
""",
)
def csv_quoting(t):
    path = scratch_path(t.spark, "quoted")
    tables.write_csv(t.documents.select("doc_id", "text", "lang"), path)
    back = tables.read_csv_text(t.spark, path)
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("digest"), "lang"
    )


@query("group_files", HARMONISED_SQL)
def group_files(t):
    folder = scratch_path(t.spark, "groups")
    for name, frame in group_frames(t).items():
        tables.write_csv(frame, f"{folder}/{name}.csv")
    frames = tables.read_group_files(t.spark, f"{folder}/group*.csv")
    return harmonise.union_complete([harmonise.harmonise(f) for f in frames])


@query("append_batches", "SELECT event_id, user_id, event_type FROM events")
def append_batches(t):
    sink = scratch_path(t.spark, "sink")
    events = t.events.select("event_id", "user_id", "event_type")
    tables.append(events.where(F.col("event_type") == "view"), sink)
    done = tables.read_done_keys(t.spark, sink, "event_id")
    tables.append(events.join(done, "event_id", "left_anti"), sink)
    return tables.read_sink(t.spark, sink, events.schema)


@query(
    "incremental_append",
    "SELECT 'c' || o_custkey AS doi, min(o_orderkey) AS first_order FROM orders GROUP BY 1",
)
def incremental_append(t):
    sink = scratch_path(t.spark, "resume")
    keys = t.orders.select(F.concat(F.lit(" C"), "o_custkey").alias("doi"), F.col("o_orderkey").alias("first_order"))
    firsts = t.orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))
    early = firsts.where(F.col("o_custkey") < 500).select(
        F.concat(F.lit("C"), "o_custkey").alias("doi"), F.col("o_orderkey").alias("first_order")
    )
    incremental.append_new(early, sink, "doi")
    incremental.append_new(keys, sink, "doi")
    return tables.read_sink(t.spark, sink)


@query("incremental_stream", "SELECT DISTINCT user_id, lower(event_type) AS event_type FROM events")
def incremental_stream(t):
    landing, sink, checkpoint = (
        scratch_path(t.spark, name) for name in ("landing", "streamed", "progress")
    )
    events = t.events.select("user_id", "event_type")
    keys = ["user_id", "event_type"]
    events.where(F.col("event_type") == "view").write.parquet(landing)
    incremental.stream_new(t.spark, landing, events.schema, sink, checkpoint, keys)
    spelled = F.concat(F.lit(" "), F.upper("event_type"))
    respelled = F.when(F.col("user_id") % 2 == 0, spelled).otherwise(F.col("event_type"))
    events.withColumn("event_type", respelled).write.mode("append").parquet(landing)
    incremental.stream_new(t.spark, landing, events.schema, sink, checkpoint, keys)
    return tables.read_sink(t.spark, sink, events.schema)


@query(
    "stable_ids",
    """
WITH s AS (SELECT s_name AS name, row_number() OVER (ORDER BY md5(s_name)) AS n FROM supplier),
c AS (SELECT c_name AS name, (SELECT count(*) FROM supplier) + row_number() OVER (ORDER BY md5(c_name)) AS n FROM customer)
SELECT md5(name) AS project, 'PROJ_' || CASE WHEN n < 100000 THEN lpad(CAST(n AS VARCHAR), 5, '0') ELSE CAST(n AS VARCHAR) END AS "ProjID"
FROM (SELECT * FROM s UNION ALL SELECT * FROM c)
""",
)
def stable_ids(t):
    """A first run numbers the suppliers; a second one has the customers, too, and renumbers none."""
    registry = scratch_path(t.spark, "registry")
    suppliers = t.supplier.select(F.md5(F.col("s_name").cast("binary")).alias("project"))
    customers = t.customer.select(F.md5(F.col("c_name").cast("binary")).alias("project"))
    numbering.stable_ids(suppliers, "project", registry)
    return numbering.stable_ids(customers.unionByName(suppliers), "project", registry)


@query(
    "keyed_lookup",
    "SELECT DISTINCT user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer)",
)
def keyed_lookup(t):
    """The users in a keyed table of all users that are customers, too."""
    table = KeyedTable(t.spark, scratch_path(t.spark, "keyed"), "user_id")
    users = t.events.select("user_id").na.drop().distinct()
    table.append(users)
    kind = users.schema["user_id"].dataType.simpleString()
    return table.lookup(t.customer.select(F.col("c_custkey").cast(kind).alias("user_id")), f"user_id {kind}")


@query(
    "matrix_file",
    "SELECT o_orderpriority AS topic, "
    + ", ".join(f"count(*) FILTER (WHERE year(o_orderdate) = {y}) AS y{y}" for y in YEARS)
    + " FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1",
)
def matrix_file(t):
    path = scratch_path(t.spark, "matrix")
    matrix = frequency.topic_by_year(order_pairs(t), YEARS)
    tables.write_matrix(matrix, path)
    return tables.read_csv(t.spark, path, matrix.schema, one_line=True)


@query(
    "summary_json",
    f"""
WITH s AS ({BY_YEAR_SQL}),
p AS (SELECT (SELECT year FROM s ORDER BY n DESC, year LIMIT 1) AS peak_year, (SELECT max(n) FROM s) AS peak_value,
  (SELECT n FROM s ORDER BY year DESC LIMIT 1) AS current_value)
SELECT year, n, peak_year, peak_value, current_value FROM s, p
""",
)
def summary_json(t):
    path = scratch_path(t.spark, "summary")
    series = yearly_outputs(t)
    tables.write_summary(frequency.summary_document(series), path)
    schema = (
        "plots struct<publications_by_year:array<struct<year:int,n:bigint>>>, "
        "stats struct<peak_year:int,peak_value:bigint,current_value:bigint>"
    )
    document = t.spark.read.schema(schema).json(path)
    return document.select(F.inline("plots.publications_by_year"), "stats.*")


@query("replaced_output", "SELECT c_custkey AS key, c_name AS name FROM customer")
def replaced_output(t):
    """A file that is written again has the new rows only."""
    path = scratch_path(t.spark, "replaced")
    tables.write_csv(t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), path)
    tables.write_csv(t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), path)
    return tables.read_csv(t.spark, path, "key bigint, name string", one_line=True)


@query("preview_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def preview_rows(t):
    ordered = t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return tables.preview(ordered)


@query(
    "empty_inputs",
    f"SELECT count(*) AS complete, count(*) FILTER (WHERE doi LIKE '10.2/%') AS without_others, 0::BIGINT AS without_any FROM ({HARMONISED_SQL})",
)
def empty_inputs(t):
    """Rows of the union if all groups have some, if only one has, and if none has."""
    frames = [harmonise.harmonise(f) for f in group_frames(t).values()]
    count = lambda kept, name: harmonise.union_complete([f if k else f.where("false") for f, k in zip(frames, kept)]).select(F.lit(name).alias("case"))
    cases = {"complete": (1, 1, 1), "without_others": (0, 1, 0), "without_any": (0, 0, 0)}
    every = reduce(DataFrame.unionByName, [count(kept, name) for name, kept in cases.items()])
    return every.agg(*[F.count_if(F.col("case") == name).alias(name) for name in cases])


@query(
    "incremental_counts",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS topic, count(*) AS n FROM orders "
    "WHERE o_orderdate IS NOT NULL OR o_orderpriority IS NOT NULL GROUP BY ALL",
)
def incremental_counts(t):
    """Three runs: urgent orders under another topic, then all with some a year late, then all as they are."""
    folder = scratch_path(t.spark, "counts")
    orders = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("topic"))
    late = F.when(F.col("topic") == "2-HIGH", F.col("year") + 1).otherwise(F.col("year"))
    runs = {
        "first": orders.where("topic = '1-URGENT'").withColumn("topic", F.lit("unknown")),
        "second": orders.withColumn("year", late),
        "third": orders,
    }
    for run, batch in runs.items():
        counts.update_counts(batch, folder, "o_orderkey", ["year", "topic"], run)
    return counts.read_counts(t.spark, folder, ["year", "topic"], "year int, topic string")
