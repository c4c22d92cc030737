import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarweave import schemas, vocabulary as V
from scholarweave.operators import frequency, harmonise, lifecycle, match, ordered
from scholarweave.plans import records
from scholarweave.sources import tables
from scholarweave.streaming import incremental
from scholarweave.workspace import scratch_path


# --- harmonising -------------------------------------------------------------


def test_harmonise_takes_the_first_real_token_over_all_aliases(spark):
    df = spark.createDataFrame(
        [("nan", "Lee, Ann; B", "2019", "A title, cut", "10.1/x"), ("", " ; ", "2018", "t", "d"), (None, "c", None, "t", "d")],
        "AUTHOR string, pi string, Year string, ProjectTitle string, doi string",
    )
    rows = [tuple(r) for r in harmonise.harmonise(df).collect()]
    assert rows == [("Lee", "2019", "A title", "10.1/x"), (None, "2018", "t", "d"), ("c", None, "t", "d")]


def test_harmonise_is_idempotent(spark):
    df = spark.createDataFrame([("a;b", "1", "t,u", "d")], "pi string, year string, title string, doi string")
    once = harmonise.harmonise(df)
    assert harmonise.harmonise(once).collect() == once.collect()


def test_a_frame_without_doi_gives_no_rows(spark):
    full = spark.createDataFrame([("a", "1", "t", "d")], "author string, year string, title string, doi string")
    frames = [harmonise.harmonise(full), harmonise.harmonise(full.drop("doi"))]
    assert harmonise.union_complete(frames).count() == 1


def test_dedupe_keeps_the_most_complete_copy(spark):
    rows = [
        (1, "10.1/A", None, None), (2, " 10.1/a", "T", "x"), (3, None, "Same  title", "Ann"),
        (4, None, "same TITLE", "ANN"), (5, None, None, "n"), (6, None, None, "n"), (7, None, "same title", None),
    ]
    df = spark.createDataFrame(rows, "id bigint, doi string, title string, author string")
    assert sorted(r.id for r in harmonise.dedupe(df, "id").collect()) == [2, 3, 5, 6, 7]


def test_ids_follow_the_key_whatever_the_partitioning(spark):
    keys = list(range(0, 500, 3))
    random.Random(7).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for parts in (1, 5):
        got = {r.k: r.ProjID for r in harmonise.with_proj_id(df.repartition(parts), "k").collect()}
        assert got == {k: f"PROJ_{i:05d}" for i, k in enumerate(sorted(keys), start=1)}
    assert harmonise.last_proj_number(harmonise.with_proj_id(df, "k")).first()[0] == len(keys)


def test_conform_and_defaults(spark):
    df = spark.createDataFrame([("x", " ")], "DOI string, OutputTitle string")
    full = harmonise.conform(df)
    assert full.columns == schemas.OUTPUT_COLUMNS
    row = harmonise.render_defaults(full, {"OutputTitle": "Unknown", "Source": ""}).first()
    assert (row.DOI, row.OutputTitle, row.Source, row.OutputYear) == ("x", "Unknown", "", None)


def test_resolve_column_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, 2)], "year int, YEAR_x int")
    assert harmonise.resolve_column(df, V.YEAR_COLUMNS) == "year"
    assert harmonise.resolve_column(df, ("Year",)) is None


# --- counts -------------------------------------------------------------------


def test_matrix_cells_and_both_totals_agree(spark):
    rng = random.Random(3)
    rows = [(str(rng.randint(1985, 1995)) if rng.random() > 0.1 else "n/a", rng.choice(["a", "b", None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "y string, t string")
    pairs = frequency.usable_years(df, "y", "t", since=1990)
    total = pairs.count()
    assert total == sum(1 for y, t in rows if t and y.isdigit() and int(y) >= 1990)
    matrix = frequency.year_by_topic(pairs, ["a", "b"])
    assert sum(sum(r[1:]) for r in matrix.collect()) == total
    totals = frequency.matrix_totals(frequency.year_topic_counts(pairs)).groupBy("axis").sum("n").collect()
    assert {r[0]: r[1] for r in totals} == {"topic": total, "year": total}


def test_funnel_never_grows(spark):
    rows = [(" ", "a"), (None, "b"), ("x", None), ("y", "z")]
    counts = [r.n for r in frequency.funnel_counts(spark.createDataFrame(rows, "a string, b string"), ["a", "b"]).orderBy("step").collect()]
    assert counts == [4, 2, 1]


def test_active_years_cover_gaps_and_skip_reversed_spans(spark):
    df = spark.createDataFrame([("2000", "2001"), ("2001", "2001"), ("2004", "2004"), ("2009", "2003"), ("x", "2000")], "s string, e string")
    got = {r.year: r.n for r in frequency.active_by_year(df, "s", "e").collect()}
    assert got == {2000: 1, 2001: 2, 2002: 0, 2003: 0, 2004: 1}


def test_pivot_over_given_values(spark):
    pairs = spark.range(3000).selectExpr("CAST(id % 2 AS STRING) AS topic", "CAST(id AS INT) AS year")
    assert frequency.year_topic_counts(pairs).count() == 3000
    some = frequency.topic_by_year(pairs.where("year < 40"), range(40)).collect()
    assert sorted(sum(r[1:]) for r in some) == [20, 20]


def test_active_years_of_a_stray_year_come_in_portions(spark, monkeypatch):
    monkeypatch.setattr(frequency, "YEARS_AT_ONCE", 7)
    df = spark.createDataFrame([("2000", "2003"), ("2050", "2050")], "s string, e string")
    got = {r.year: r.n for r in frequency.active_by_year(df, "s", "e").collect()}
    assert got == {y: int(y <= 2003 or y == 2050) for y in range(2000, 2051)}


def test_sample_is_exact_and_independent_of_layout(spark):
    df = spark.range(1000)
    a = {r.id for r in ordered.sample_n(df.repartition(7), "id").collect()}
    b = {r.id for r in ordered.sample_n(df.coalesce(1), "id").collect()}
    assert len(a) == 150 and a == b
    assert a != {r.id for r in ordered.sample_n(df, "id", seed=1).collect()}


# --- matching -------------------------------------------------------------------


def test_best_work_prefers_a_title_match_and_may_look_at_one_page(spark):
    works = spark.createDataFrame(
        [("ann", 1, "Unrelated"), ("ann", 2, "Census Bureau wages"), ("ann", 3, "FSRDC firm entry"), ("ann", 4, "FSRDC firm exit")],
        "author string, rank int, title string",
    )
    kinds = "array<struct<name:string>>"
    work = F.struct(
        "title", F.lit(None).cast("string").alias("abstract"), F.lit(None).cast("string").alias("fullText"),
        F.lit(None).cast("array<string>").alias("keywords"), F.lit(None).cast(kinds).alias("institutions"),
    )
    projects = spark.createDataFrame(
        [(1, "ann", "FIRM"), (2, "ann", "exit"), (3, "bob", "x"), (4, None, "x")], "id int, author string, title string"
    )
    title_only = {"work": work, "fields": ["title"]}
    got = {r.id: r.work and r.work.title for r in match.best_work(projects, works, candidates=3, **title_only).collect()}
    assert got == {1: "FSRDC firm entry", 2: "Census Bureau wages", 3: None, 4: None}
    got = {r.id: r.work and r.work.title for r in match.best_work(projects, works, **title_only).collect()}
    assert got == {1: "FSRDC firm entry", 2: "FSRDC firm exit", 3: None, 4: None}


def test_a_related_work_at_any_place_is_found_and_ties_are_stable(spark):
    rows = [("ann", i, f"Nothing {i}") for i in range(30)] + [("ann", 40, "Census Bureau b"), ("ann", 40, "Census Bureau a")]
    works = spark.createDataFrame(rows, "author string, rank int, title string")
    none = F.lit(None).cast("string")
    work = F.struct(
        "title", none.alias("abstract"), none.alias("fullText"), F.lit(None).cast("array<string>").alias("keywords"),
        F.lit(None).cast("array<struct<name:string>>").alias("institutions"),
    )
    projects = spark.createDataFrame([(1, "ann", "zzz")], "id int, author string, title string")
    for parts in (1, 5):
        found = match.best_work(projects, works.repartition(parts), work, fields=["title"]).first()
        assert found.work.title == "Census Bureau a"


def test_a_titled_work_in_any_group_is_found(spark):
    df = spark.sql("SELECT array(array(w), array(w), array(w), array(w), array(w), array(named_struct('title', 'T'))) AS g FROM (SELECT CAST(NULL AS struct<title:string>) AS w)")
    assert df.select(match.first_grouped_work("g")["title"].alias("t")).first().t == "T"
    assert df.select(match.first_grouped_work("g", 5)["title"].alias("t")).first().t is None


def test_a_name_of_one_word_meets_nobody(spark):
    people = spark.createDataFrame([("Ann", "Lee", "1", 2), ("Bo", "Lee", "0", 1)], "given string, family string, orcid string, rank int")
    projects = spark.createDataFrame([(1, "Ann Lee"), (2, "C. Lee"), (3, "Lee"), (4, None)], "id int, name string")
    found = match.resolve_pi(projects, people, "name", "id").collect()
    assert {r.id: r.orcid for r in found} == {1: "1", 2: "0", 3: None, 4: None}


def test_page_limit_is_applied_before_the_shuffle(spark):
    works = spark.range(100).select((F.col("id") % 3).alias("author"), F.col("id").alias("rank"))
    plan = ordered.limit_per_key(works, "author", ["rank"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_relevant_work_takes_the_last_match_else_the_first(spark):
    df = spark.sql(
        """SELECT from_json('[{"title":{"title":{"value":"One"}}},{"title":{"title":{"value":"Two wages"}}},
        {"title":{"title":{"value":"Three WAGES"}}},{"title":{"title":{"value":"Four"}}}]',
        'array<struct<title:struct<title:struct<value:string>>>>') AS works"""
    )
    for wanted, expected in (("wages", "Three WAGES"), ("nothing", "One"), ("one", "One")):
        work = df.select(match.relevant_work("works", F.lit(wanted)).alias("w")).first().w
        assert work.title.title.value == expected


def test_pending_normalises_before_comparing(spark):
    keys = spark.createDataFrame([(" A ",), ("a",), ("B",), (None,)], "doi string")
    done = spark.createDataFrame([("b",)], "doi string")
    assert [r.doi for r in match.pending(keys, done, "doi").collect()] == ["a"]
    assert match.pending(keys, None, "doi").count() == 2


def test_rows_without_a_key_are_spread(spark):
    df = spark.range(100).select("id", match.spread_nulls(F.lit(None).cast("string"), "id").alias("k"))
    assert df.select("k").distinct().count() == 100


# --- life cycle ------------------------------------------------------------------


def spans(spark):
    rng = random.Random(11)
    rows = []
    for i in range(200):
        start = rng.randint(1990, 2000)
        long = rng.random() < 0.3
        rows.append((i, start, start + rng.randint(10, 14) if long else start + rng.randint(-1, 3), start + rng.randint(-1, 5)))
    return spark.createDataFrame(rows, "i int, s int, e int, o int"), rows


def test_standard_scores_and_weighted_scores(spark):
    df, _ = spans(spark)
    life = lifecycle.with_lifecycle(df, "s", "e", "o")
    values = np.array([(r.duration, r.time_to_publish) for r in life.orderBy("i").collect()], float)
    expected = (values - values.mean(0)) / values.std(0)
    got = lifecycle.standardise(life, lifecycle.FEATURES).orderBy("i").collect()
    assert np.allclose([(r.duration, r.time_to_publish) for r in got], expected)
    weighted = lifecycle.weighted_scores(lifecycle.feature_groups(life), lifecycle.FEATURES)
    again = life.select("i", *[w.alias(c) for c, w in weighted.items()]).orderBy("i").collect()
    assert np.allclose([(r.duration, r.time_to_publish) for r in again], expected)


def test_constant_column_scores_zero(spark):
    df = spark.createDataFrame([(1, 5), (2, 5)], "a int, b int")
    assert [r.b for r in lifecycle.standardise(df, ["b"]).collect()] == [0.0, 0.0]


def test_clusters_are_a_stable_point_of_k_means(spark):
    df, _ = spans(spark)
    rows = lifecycle.lifecycle_clusters(lifecycle.with_lifecycle(df, "s", "e", "o")).collect()
    raw = np.array([(r.duration, r.time_to_publish) for r in rows], float)
    z = (raw - raw.mean(0)) / raw.std(0)
    labels = np.array([r.lifecycle_cluster for r in rows])
    centres = np.array([z[labels == k].mean(0) for k in (0, 1)])
    nearest = ((z[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
    assert (nearest == labels).mean() > 0.99
    assert raw[labels == 0, 0].mean() < raw[labels == 1, 0].mean()


def test_components_match_a_singular_value_decomposition(spark):
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 20, size=(12, 4))
    matrix = spark.createDataFrame(
        [(1990 + i, *map(int, r)) for i, r in enumerate(counts)], "year int, a bigint, b bigint, c bigint, d bigint"
    )
    z = (counts - counts.mean(0)) / counts.std(0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    scores = np.array([tuple(r)[1:] for r in lifecycle.topic_pca(matrix).orderBy("year").collect()])
    for i in range(4):
        sign = 1 if vt[i][np.abs(vt[i]).argmax()] >= 0 else -1
        assert np.allclose(scores[:, i], sign * z @ vt[i], atol=1e-6)
    shares = lifecycle.explained_variance(matrix).orderBy("component").collect()
    assert np.allclose([r.share for r in shares], s**2 / (s**2).sum())
    assert shares[-1].running_share == pytest.approx(1.0)


# --- sinks and increments ---------------------------------------------------------


def test_blank_and_null_are_both_missing_after_csv(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([("a", 'say "hi", ok'), ("", "two\nlines"), (None, "x")], "a string, b string")
    tables.write_csv(df, path)
    back = tables.read_csv(spark, path, df.schema)
    assert sorted(r.b for r in back.collect()) == ['say "hi", ok', "two\nlines", "x"]
    assert tuple(tables.present_counts(back, ["a", "b"]).first()) == (3, 1, 3)


def test_missing_group_files_are_skipped(spark):
    folder = scratch_path(spark, "groups")
    tables.write_csv(spark.createDataFrame([("a", "1", "t", "d")], "PI string, year string, title string, DOI string"), f"{folder}/group2.csv")
    frames = tables.read_group_files(spark, f"{folder}/group*.csv")
    assert len(frames) == 1
    none = tables.read_group_files(spark, f"{folder}/none*.csv")
    assert none == [] and harmonise.union_complete(none).columns == schemas.HARMONISED_COLUMNS


def test_a_sink_replaces_earlier_output(spark):
    path = scratch_path(spark, "csv")
    for rows in ([("a",), ("b",)], [("c",)]):
        tables.write_csv(spark.createDataFrame(rows, "a string"), path)
    assert [r.a for r in tables.preview(tables.read_csv_text(spark, path)).collect()] == ["c"]


def test_files_are_split_whether_or_not_fields_may_span_lines(spark):
    path = scratch_path(spark, "csv")
    spark.range(200_000).selectExpr("id", "repeat('x', 30) AS t").coalesce(1).write.option("header", True).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        parts = [tables.read_csv(spark, path, "id long, t string", one_line=m).rdd.getNumPartitions() for m in (False, True)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert min(parts) > 4


def test_two_runs_equal_one_run_on_the_union(spark):
    first = spark.createDataFrame([("A", 1), ("b", 2)], "doi string, n int")
    second = spark.createDataFrame([("a ", 9), ("c", 3), ("C", 4), ("c", None), (None, 5)], "doi string, n int")
    twice, once = scratch_path(spark, "twice"), scratch_path(spark, "once")
    for batch in (first, second, second):
        incremental.append_new(batch, twice, "doi")
    incremental.append_new(first.unionByName(second), once, "doi")
    expected = [("a", 1), ("b", 2), ("c", 3)]
    for sink in (twice, once):
        assert [tuple(r) for r in tables.read_sink(spark, sink).orderBy("doi").collect()] == expected


def test_stream_resumes_from_its_checkpoint(spark):
    landing, sink, progress = (scratch_path(spark, n) for n in ("land", "sink", "progress"))
    a = spark.createDataFrame([("x", 1), ("y", 1)], "k string, n int")
    b = spark.createDataFrame([(" Y", 1), ("z", 1), (None, 1)], "k string, n int")
    for batch in (a, b):
        batch.write.mode("append").parquet(landing)
        incremental.stream_new(spark, landing, batch.schema, sink, progress, ["k"])
    assert sorted(r.k for r in tables.read_sink(spark, sink, a.schema).collect()) == ["x", "y", "z"]


def test_related_records_standardise_centres(spark):
    cols = ["ProjectRDC", "ProjectTitle", "OutputTitle", "OutputVenue", "OutputBiblio", "ProjectPI"]
    rows = [("U Michigan", "x", "LEHD wages", None, None, "p"), ("Texas", "x", "y", None, None, "p")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    assert [r.ProjectRDC for r in records.related_records(df).collect()] == ["Michigan RDC"]
