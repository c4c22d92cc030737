"""Keys of titles: the same for every kind of white space, and computed a single time."""

import random
import re

from pyspark.sql import functions as F

from scholarweave.functions.text import norm_words
from scholarweave.operators import match

SPACES = "[\\s\u001c-\u001f\u0085   -     　]+"


def test_words_of_titles_with_every_kind_of_white_space(spark):
    rng = random.Random(5)
    parts = [" ", "  ", "   ", "\t", "\n", "\u000b", "\u001c", "\u0085", " ", " ", "　", "A", "bc", "É", "é", "~", "\u007f", "\u0001"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 9))) for _ in range(400)]
    texts += ["".join(rng.choices([" ", "  ", "   ", "A", "b", "~!"], k=rng.randrange(0, 9))) for _ in range(400)] + [None, "", " ", "A b", "A b\n", "\nA b"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = {r.id: r.w for r in df.select("id", norm_words("t").alias("w")).collect()}
    for i, t in enumerate(texts):
        assert found[i] == (None if t is None else re.sub(SPACES, " ", t).strip(" ").lower() or None), t


def test_title_keys_of_the_index_are_computed_once(spark, monkeypatch):
    stored = {}
    plain = match.materialise

    def kept(df, label):
        stored[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return plain(df, label)

    monkeypatch.setattr(match, "materialise", kept)
    index = spark.createDataFrame(
        [("10.1/a", "A  Title", "Ann; Bo", "P2"), (None, "a title", "ANN", "P1"), (None, None, "Ann", "P0"), ("10.1/c", "x", None, "P4"), (None, " ", "Ann", "P5")],
        "doi string, title string, author string, pmcid string",
    )
    records = spark.createDataFrame(
        [(1, "A\tTITLE", "ann, x", "10.1/z"), (1, "q", None, " 10.1/A "), (2, None, "Ann", None), (None, "x", None, None), (3, " ", "Ann", None), (4, "x", "Bo", "10.1/C")],
        "id int, title string, author string, doi string",
    )
    found = match.match_cascade(records, index).select("ProjID", "DOI", "PMCID", "Method", "Reason").collect()
    assert sorted(map(tuple, found), key=str) == sorted([
        (1, "10.1/z", "P1", "Title/Author", "Found by title/author"), (1, " 10.1/A ", "P2", "DOI", "Found by DOI"),
        (2, None, None, None, "Missing title or author"), (None, None, None, None, "Missing title or author"),
        (3, None, None, None, "Missing title or author"), (4, "10.1/C", "P4", "DOI", "Found by DOI"),
    ], key=str)
    assert stored["by-title"].count("sha2(") == 1 and "Filter" not in stored["by-title"]
