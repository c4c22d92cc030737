"""Tables that grow by runs: killed and repeated runs, and what a keyed table reads."""

import pytest
from pyspark.sql import functions as F

from scholarweave.operators import harmonise, numbering
from scholarweave.plans.pipeline import numbered_projects
from scholarweave.sources import tables
from scholarweave.sources.stored import KeyedTable, StoredTable
from scholarweave.streaming import incremental
from scholarweave.workspace import scratch_path


class Killed(Exception):
    pass


def kill(monkeypatch, method):
    def die(*_):
        raise Killed

    monkeypatch.setattr(StoredTable, method, die)


@pytest.mark.parametrize("kind", ["plain", "keyed"])
def test_a_run_that_is_killed_adds_nothing_and_can_be_repeated(spark, monkeypatch, kind):
    path = scratch_path(spark, "table")
    table = StoredTable(spark, path) if kind == "plain" else KeyedTable(spark, path, "id", 4)
    table.append(spark.range(3), "first")
    with monkeypatch.context() as patch, pytest.raises(Killed):
        kill(patch, "_publish")
        table.append(spark.range(3, 9), "second")
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2]
    assert len(table.unread()) == (1 if kind == "plain" else 2)
    assert table.append(spark.range(3, 9), "second")
    assert not table.append(spark.range(3, 9), "second") and not table.append(spark.range(99), "first")
    assert sorted(r.id for r in table.read().collect()) == list(range(9))
    table.discard_unread()
    assert table.unread() == [] and table.read().count() == 9


def test_two_attempts_at_once_publish_one(spark, monkeypatch):
    table = StoredTable(spark, scratch_path(spark, "table"))
    publish = StoredTable._publish

    def late(self, run):
        monkeypatch.setattr(StoredTable, "_publish", publish)
        assert table.append(spark.range(5), "run")  # another attempt is faster
        publish(self, run)

    monkeypatch.setattr(StoredTable, "_publish", late)
    with pytest.raises(Exception, match="exist"):
        table.append(spark.range(5), "run")
    assert table.read().count() == 5


def test_names_and_empty_tables(spark):
    path = scratch_path(spark, "table")
    table = StoredTable(spark, path)
    assert table.read() is None and table.runs() == [] and tables.read_done_keys(spark, path, "id") is None
    assert table.read("id long").collect() == []
    with pytest.raises(ValueError):
        table.append(spark.range(1), "../other")
    table.append(spark.range(0))
    assert table.read().count() == 0


def test_what_a_keyed_table_reads_grows_with_the_batch(spark):
    table = KeyedTable(spark, scratch_path(spark, "table"), "id", 64)
    for start in range(0, 6000, 2000):
        table.append(spark.range(start, start + 2000))
    files = lambda *ids: len(table.parts_with(spark.createDataFrame([(i,) for i in ids], "id long")))
    assert files() == 0
    assert 1 <= files(17) <= 3 and 1 <= files(17, 5017) <= 6
    assert files(*range(20)) <= 20 + 60 // 8 + 3
    assert files(*range(100_000, 100_010)) <= 8  # keys that are not there pass a filter by chance only
    # No part is left out that holds a key, and the plan reads the parts alone.
    batch = spark.range(1990, 2010)
    known = table.known(batch)
    assert len(known.inputFiles()) == len(table.parts_with(batch)) < 192
    assert known.join(batch, "id", "left_semi").count() == 20
    assert sorted(r.id for r in table.missing(spark.range(5990, 6010)).collect()) == list(range(6000, 6010))


def test_filters_have_no_false_negatives_with_many_pages(spark, monkeypatch):
    monkeypatch.setattr("scholarweave.sources.stored._BITS_PER_KEY", 200)
    keys = spark.range(20_000).select(F.concat(F.lit("key "), "id").alias("k"), "id")
    table = KeyedTable(spark, scratch_path(spark, "table"), ["k", "id"], 8)
    table.append(keys)
    assert table.runs()[0].facts["pages"] > 8
    assert table.missing(keys).count() == 0 and table.lookup(keys.limit(50), "k string, id long").count() == 50
    assert KeyedTable(spark, table.path, ["k", "id"], 99).buckets == 8  # as the table was begun


def test_compacting_keeps_rows_and_names(spark):
    table = KeyedTable(spark, scratch_path(spark, "table"), "id", 4)
    for run, start in (("a", 0), ("b", 10), ("c", 20)):
        table.append(spark.range(start, start + 10), run)
    table.compact("all")
    assert len(table.runs()) == 1 and table.read().count() == 30
    assert not table.append(spark.range(10), "b")
    table.append(spark.range(30, 35), "d")
    table.compact()
    table.discard_unread()
    assert sorted(r.id for r in table.read().collect()) == list(range(35)) and not table.append(spark.range(1), "a")
    assert table.missing(spark.range(40)).count() == 5


def test_ids_stay_when_keys_are_added(spark):
    registry = scratch_path(spark, "registry")
    keys = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    ids = lambda *ks: {r.k: r.ProjID for r in numbering.stable_ids(keys(*ks), "k", registry, 4).collect()}
    first = ids("m", "c", "c", None)
    assert first == {"c": "PROJ_00001", "m": "PROJ_00002"}
    second = ids("a", "m", "z")
    assert second == {"m": "PROJ_00002", "a": "PROJ_00003", "z": "PROJ_00004"}
    assert ids() == {} and ids("a", "b") == {"a": "PROJ_00003", "b": "PROJ_00005"}


def test_a_further_group_file_changes_no_project_id(spark):
    output = scratch_path(spark, "registry")
    names = "author string, year string, title string, doi string"
    first = spark.createDataFrame([(f"P{i}", "2001", f"T{i}", f"10.1/{i}") for i in range(30)], names)
    more = spark.createDataFrame([(f"Q{i}", "2001", f"T{i}", f"10.1/{i}") for i in range(30)], names)
    before = {r.author: (r.ProjID, r.id) for r in numbered_projects(first, output).collect()}
    after = {r.author: (r.ProjID, r.id) for r in numbered_projects(harmonise.union_complete([more, first]), output).collect()}
    assert {k: v for k, v in after.items() if k in before} == before
    assert sorted(n for _, n in after.values()) == list(range(1, 61))


def test_a_batch_that_the_stream_repeats_is_added_once(spark, monkeypatch):
    landing, sink, progress = (scratch_path(spark, n) for n in ("land", "sink", "progress"))
    rows = spark.createDataFrame([("x", 1), ("y", 1), (" X", 2)], "k string, n int")
    rows.write.parquet(landing)
    publish = StoredTable._publish

    def late(self, run):
        publish(self, run)
        raise Killed  # after the sink has the batch, before the stream knows

    with monkeypatch.context() as patch, pytest.raises(Exception):
        patch.setattr(StoredTable, "_publish", late)
        incremental.stream_new(spark, landing, rows.schema, sink, progress, ["k"])
    incremental.stream_new(spark, landing, rows.schema, sink, progress, ["k"])
    assert sorted(r.k for r in tables.read_sink(spark, sink).collect()) == ["x", "y"]


def test_the_stream_keeps_no_state(spark):
    import os

    landing, sink, progress = (scratch_path(spark, n) for n in ("land", "sink", "progress"))
    for run in range(3):
        batch = spark.range(run * 50, run * 50 + 100).selectExpr("concat('k', id) AS k", "1 AS n")
        batch.write.mode("append").parquet(landing)
        incremental.stream_new(spark, landing, batch.schema, sink, progress, ["k"])
    assert tables.read_sink(spark, sink).count() == 200
    assert not os.path.exists(f"{progress.removeprefix('file:')}/state")
