"""Counts after several runs against a recount of the latest records."""

import random
from collections import Counter

import pytest

from scholarweave.operators import counts
from scholarweave.sources.stored import KeyedTable, StoredTable
from scholarweave.workspace import scratch_path


def test_runs_against_a_recount(spark, monkeypatch):
    rng = random.Random(2)
    folder, latest = scratch_path(spark, "counts"), {}
    for run in range(4):
        batch = {k: (rng.choice([None, 1999, 2000]), rng.choice([None, "a", "b"])) for k in rng.sample(range(60), 40)}
        rows = [(k, *v) for k, v in batch.items()] + [(None, 2000, "a")]
        df = spark.createDataFrame(rows, "k long, year int, topic string")
        update = lambda: counts.update_counts(df, folder, "k", ["year", "topic"], f"run-{run}")  # noqa: B023, E731
        if run == 2:  # killed when the counts are there and the records are not
            append = KeyedTable.append
            with monkeypatch.context() as patch, pytest.raises(RuntimeError):
                patch.setattr(KeyedTable, "append", lambda *_: (_ for _ in ()).throw(RuntimeError()))
                patch.setattr(StoredTable, "append", append)
                update()
        update()
        update()  # a run that is repeated changes nothing
        latest |= batch
        found = counts.read_counts(spark, folder, ["year", "topic"], "year int, topic string").collect()
        assert {(r.year, r.topic): r.n for r in found} == Counter(v for v in latest.values() if v != (None, None))


def test_repeated_keys_and_empty_batches(spark):
    folder = scratch_path(spark, "counts")
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "a")], "k long, topic string")
    counts.update_counts(df.where("topic is not null"), folder, "k", ["topic"], "one")
    counts.update_counts(df.where("false"), folder, "k", ["topic"], "two")
    read = lambda: {r.topic: r.n for r in counts.read_counts(spark, folder, ["topic"], "topic string").collect()}
    assert read() == {"a": 2}
    counts.update_counts(df.where("topic is null"), folder, "k", ["topic"], "three")
    assert read() == {"a": 1}
