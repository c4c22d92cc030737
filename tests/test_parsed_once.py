"""Payloads are parsed a single time, and texts searched once for keywords that share a part."""

import itertools

from pyspark.sql import functions as F

from scholarweave import schemas, vocabulary as V
from scholarweave.functions import predicates
from scholarweave.operators import match
from scholarweave.plans import pipeline
from scholarweave.sources.payloads import parse_json


def plans_of(monkeypatch, module):
    stored = {}
    plain = module.materialise

    def kept(df, label):
        stored[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return plain(df, label)

    monkeypatch.setattr(module, "materialise", kept)
    return stored


def test_records_without_an_output_are_dropped_after_they_are_stored(spark, monkeypatch):
    stored = plans_of(monkeypatch, pipeline)
    rows = [("1", '{"title": "A"}'), ("2", '{"title": "a "}'), ("3", "{}"), ("4", None), ("5", "{broken")]
    landed = spark.createDataFrame(rows, "ProjID string, body string")
    records = landed.select("ProjID", parse_json("body", schemas.CORE_WORK)["title"].alias("OutputTitle"), F.lit("P").alias("ProjectPI"))
    found = pipeline.combine({"X": records}).select("ProjID", "OutputTitle", "Source").collect()
    assert list(map(tuple, found)) == [("1", "A", "X")]
    assert stored["records"].count("from_json(") == 1


def test_works_are_parsed_once_for_both_searches(spark, monkeypatch):
    stored = plans_of(monkeypatch, match)
    works = spark.createDataFrame([("P", 1, '{"title": "FSRDC wages"}'), ("P", 2, '{"title": "Irs firms"}')], "author string, rank int, body string")
    projects = spark.createDataFrame([(1, "P", "firms"), (2, "P", "x"), (3, None, "firms")], "id int, author string, title string")
    found = match.best_work(projects, works, parse_json("body", schemas.CORE_WORK))
    assert {r.id: r.work and r.work.title for r in found.collect()} == {1: "Irs firms", 2: "FSRDC wages", 3: None}
    assert stored["related-works"].count("from_json(") == 1
    assert "from_json(" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_groups_of_keywords_say_the_same_as_single_ones(spark):
    words = [w.lower() for w in V.RELATED_KEYWORDS_LONG]
    groups = predicates.by_shared_part(words)
    assert sorted(itertools.chain(*[g for _, g in groups])) == sorted(words) and len(groups) < len(words) * 0.6
    assert predicates.by_shared_part([]) == [] and predicates.by_shared_part(["a", "a"]) == [("a", ["a"])]
    assert sorted(predicates.by_shared_part(["ab", "ab c", "x", " "])) == [(" ", [" "]), ("ab", ["ab", "ab c"]), ("x", ["x"])]
    texts = [f"so {w.upper()} it" for w in words] + [w[:-1] for w in words] + [w[1:] for w in words] + [p for p, _ in groups] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for listed in (V.RELATED_KEYWORDS_LONG, V.RELATED_KEYWORDS, ("ab", "ab c", "Title")):
        found = {r.id: r.hit for r in df.select("id", predicates.contains_any("t", listed).alias("hit")).collect()}
        assert found == {i: t is not None and any(w.lower() in t.lower() for w in listed) for i, t in enumerate(texts)}
