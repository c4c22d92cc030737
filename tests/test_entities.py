"""Entities over several keys, and titles found by their words, against plain versions."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from scholarweave.operators import entities, title_search as T
from scholarweave.operators import match
from scholarweave.operators.match import first_author


def brute_merge(rows, fields):
    """rows: (id, doi, title, author, arxiv, note)"""
    keys = []
    for _, doi, title, author, arxiv, _ in rows:
        found = set()
        if doi and doi.strip():
            found.add(("doi", doi.strip().lower()))
        if title and title.strip() and author and author.strip():
            found.add(("title", " ".join(title.lower().split()), " ".join(author.lower().split())))
        if arxiv and arxiv.strip():
            found.add(("arxiv", arxiv.strip().lower()))
        keys.append(found)
    group = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if keys[i] & keys[j]:
                    group[i] = group[j] = min(group[i], group[j])
    out = []
    for g in set(group):
        members = sorted((sum(v is None for v in r[1:]), r[0], r) for r, own in zip(rows, group) if own == g)
        first = [next((m[2][k] for m in members if m[2][k] is not None), None) for k in range(1, len(fields) + 1)]
        out.append((min(m[1] for m in members), *first, len(members)))
    return sorted(out)


def test_merging_against_brute_force(spark):
    rng = random.Random(4)
    pick = lambda *values: rng.choice([None, *values])
    rows = [
        (i, pick(*(f"10.1/{k}" for k in range(60)), " 10.1/X ", "10.1/x"), pick("Wages", "wages ", "Firms", f"T{i % 50}"), pick("Ann", "ANN", f"P{i % 40}"), pick(*(f"a{k}" for k in range(80))), pick("n", "m"))
        for i in range(90)
    ]
    rows += [(100, "10.1/chain", None, None, None, None), (101, "10.1/Chain", "A tale", "Bo", None, "x"), (102, None, "a  Tale", "bo", "Q1", None), (103, None, None, None, "q1", "y")]
    rows += [(200 + i, None, None, None, None, None) for i in range(3)] + [(300, "", " ", None, None, None), (301, "", " ", None, None, None)]
    fields = ["doi", "title", "author", "arxiv", "note"]
    df = spark.createDataFrame(rows, "id long, doi string, title string, author string, arxiv string, note string")
    found = entities.merge(df, "id", entities.identity_keys(ids=["arxiv"]))
    assert found.columns == ["id", *fields, "n_records"]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == brute_merge(rows, fields)
    chain = [r for r in found.collect() if r.id == 100][0]
    assert chain.n_records == 4 and chain.author == "Bo" and chain.arxiv == "Q1"


def test_a_third_of_all_records_equal_and_text_ids(spark):
    rows = [(f"r{i:03d}", "10.1/same" if i % 3 == 0 else f"10.1/{i}", None, None) for i in range(90)]
    df = spark.createDataFrame(rows, "id string, doi string, title string, author string")
    found = {r.id: r.n_records for r in entities.merge(df, "id", entities.identity_keys()).collect()}
    assert found["r000"] == 30 and len(found) == 61
    empty = entities.merge(df.where("false"), "id", entities.identity_keys())
    assert empty.collect() == []


def brute_titles(asked, listed, overlap):
    words = lambda t: set(re.findall(r"[^\W_]+", t.lower())) if t else set()
    author = lambda a: re.split("[;,]", a)[0].split()[0].lower() if a and re.split("[;,]", a)[0].split() else None
    out = {}
    for i, title, who in asked:
        best = None
        for j, other, whose in listed:
            a, b = words(title), words(other)
            if a and b and author(who) is not None and author(who) == author(whose):
                share = len(a & b) / len(a | b)
                if share >= overlap - 1e-9 and (best is None or (-share, j) < best):
                    best = (-share, j)
        out[i] = (None, None) if best is None else (best[1], round(-best[0], 9))
    return out


def test_titles_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(25)] + ["the", "of", "é", "États"]
    make = lambda: " ".join(rng.choices(vocabulary, weights=[1] * 25 + [9, 9, 2, 2], k=rng.randrange(1, 12)))
    listed = [(i, make(), rng.choice(["Ann Lee", "Bo; X", "cy"])) for i in range(150)]
    asked = []
    for i in range(200):
        _, title, who = rng.choice(listed)
        words = title.split()
        rng.shuffle(words)
        asked.append((i, rng.choice(["-", "  ", ", "]).join(words[rng.randrange(2) :]).upper(), who))
    asked += [(1000, None, "Ann"), (1001, "", "Ann"), (1002, "w1 w2", None), (1003, "!!", "cy"), (1004, asked[0][1], asked[0][2])]
    listed += [(2000, None, "cy"), (2001, "w1 w2", None), (2002, listed[0][1], listed[0][2])]
    names = "title string, author string"
    a, b = spark.createDataFrame(asked, f"id long, {names}"), spark.createDataFrame(listed, f"pmcid long, {names}")
    for overlap in (0.8, 0.5, 1.0):
        found = T.with_match(a, b, first_author("author"), "pmcid", overlap).collect()
        got = {r.id: (r.pmcid, None if r.share is None else round(r.share, 9)) for r in found}
        assert len(found) == len(asked) and got == brute_titles(asked, listed, overlap), overlap


def test_frequent_words_decide_the_order_only(spark):
    rows = [(i, f"the study of the {i % 30} {i % 7}", "x") for i in range(120)]
    df = spark.createDataFrame(rows, "pmcid long, title string, author string")
    results = [sorted(map(tuple, T.title_matches(df, df, F.col("author"), "pmcid", frequent_words=n).select("words", "pmcid", "share").collect())) for n in (1, 10_000)]
    assert results[0] == results[1] and len(results[0]) == 120
    assert T.title_matches(df.where("false"), df, F.col("author"), "pmcid").collect() == []


def test_titles_with_common_words_are_looked_up_not_paired(spark):
    """4,096 titles of one author: each overlaps with 28 others, but meets at most ten rows."""
    words = [[f"{place}{i}" for i in range(8)] for place in "abcd"]
    rows = [(n, " ".join(title), "x") for n, title in enumerate(itertools.product(*words))]
    df = spark.createDataFrame(rows, "pmcid long, title string, author string")
    scored = []
    plain = T._short_matches

    def counted(*args):
        scored.append(plain(*args))
        return scored[-1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(T, "_short_matches", counted)
        found = T.with_match(df.withColumnRenamed("pmcid", "id"), df.where("pmcid > 0"), F.col("author"), "pmcid", 0.6)
        got = {r.id: (r.pmcid, r.share) for r in found.collect()}
    assert got == {n: (n, 1.0) if n else (1, 0.6) for n, _, _ in rows}
    assert scored[0].count() <= 10 * len(rows)


def test_short_and_long_titles_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    listed = [(i, " ".join(rng.sample(vocabulary, rng.randrange(10, 24))), "cy") for i in range(80)]
    asked = []
    for i in range(120):
        words = rng.choice(listed)[1].split()
        asked.append((i, " ".join(rng.sample(words, len(words) - rng.randrange(4)) + rng.sample(vocabulary, rng.randrange(3))), "cy"))
    names = "title string, author string"
    a, b = spark.createDataFrame(asked, f"id long, {names}"), spark.createDataFrame(listed, f"pmcid long, {names}")
    got = {r.id: (r.pmcid, None if r.share is None else round(r.share, 9)) for r in T.with_match(a, b, F.col("author"), "pmcid", 0.8).collect()}
    assert got == brute_titles(asked, listed, 0.8) and sum(share is not None for _, share in got.values()) > 50


def test_best_works_of_an_author_with_many_titles(spark, monkeypatch):
    """The same works whether all titles are compared with all works or meet by a part."""
    rng = random.Random(11)
    words = ["FSRDC", "wages", "of", "é", "firms", "Title 13", "x-y", "a", "census"]
    make = lambda n: rng.choice([" ", ", ", "  "]).join(rng.choices(words, k=n))
    titles = [make(rng.randrange(1, 5)) for _ in range(60)] + ["", "a", "fs", "ages of fir", "-y", " wages "]
    projects = [(i, f"P{i % 2}", t) for i, t in enumerate(titles)] + [(900, None, "wages"), (901, "P1", None)]
    works = [(f"P{i % 2}", i // 3, "FSRDC " + make(rng.randrange(1, 9))) for i in range(80)] + [("P0", 99, None)]
    p = spark.createDataFrame(projects, "id int, author string, title string")
    w = spark.createDataFrame(works, "author string, rank int, title string").withColumn("work", F.struct("title"))

    def kept(limit):
        monkeypatch.setattr(match, "TITLES_PAIRED", limit)
        found = match.best_work(p, w, related=lambda work: work["title"].isNotNull(), fields=["title"])
        return sorted((r.id, r.work.title if r.work else None) for r in found.collect())

    plain = []
    for i, author, title in projects:
        own = sorted((r, t) for a, r, t in works if a == author and t is not None)
        fit = [t for _, t in own if title is not None and title.lower() in t.lower()]
        plain.append((i, (fit or [t for _, t in own] or [None])[0]))
    assert kept(64) == kept(0) == sorted(plain)


def test_records_are_read_and_their_keys_computed_once(spark, monkeypatch):
    stored = []
    plain = entities.materialise

    def kept(df, label):
        stored.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, label)

    monkeypatch.setattr(entities, "materialise", kept)
    rows = [(1, "10.1/a", "T", "x"), (2, "10.1/A ", None, None), (3, "10.1/b", "t ", "X"), (3, None, "q", "y"), (None, None, None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, doi string, title string, author string")
    found = entities.merge(df, "id", entities.identity_keys())
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "10.1/a", "T", "x", 3), (3, None, "q", "y", 1), (None, None, None, None, 2)]
    assert len(stored) == 1 and "ExternalRDD" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, entities.resolve(df, "id", entities.identity_keys()).select("n").collect())) == [(1,), (1,), (1,), (1,), (2,)]
