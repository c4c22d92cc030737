"""Titles that have nearly the same words, by the sets of words that two have in common.

Two titles match if their authors are equal and their sets of words overlap by a given part
of all words of both. So both become one set if each loses the few words that it has alone.
A short title is kept under every set that is left when it loses as many words as the overlap
allows, and titles meet where such sets are equal. The overlap follows from the numbers of
words lost, so of the listed titles under a set only the smallest is kept for each number:
titles are looked up and never paired, however many of an author have words in common.

Longer titles would leave too many sets. If the words of each are put in one order, two that
overlap so much share one of their first words, how many of them follows from the length
alone. With rare words first, few titles share one. Candidates are verified by their whole
sets, so what is found is exact, whatever the order.
"""

from __future__ import annotations

import json
import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from scholarweave.functions.text import norm_words
from scholarweave.workspace import materialise

#: Words whose frequency is looked up; all others are rarer than these and go before them.
FREQUENT_WORDS = 10_000
#: Sets that a short title may leave: 14 words at an overlap of 0.8.
MOST_SETS = 200
MOST_SHORT = 64


def title_words(title: str) -> Column:
    """Distinct words of a title: letters and digits, in lower case."""
    words = F.split(F.regexp_replace(norm_words(title), r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def _sets(df: DataFrame, title: str, author: Column, kept: Column) -> DataFrame:
    """(author, words, kept, n) of each set of words of an author; equal ones are one, so that
    a title with very many records is no hot spot. ``kept`` takes part as its smallest value."""
    words = F.array_sort(title_words(title))
    rows = df.select(F.lower(author).alias("author"), words.alias("words"), kept.alias("kept"))
    return rows.where((F.size("words") > 0) & F.col("author").isNotNull()).groupBy("author", "words").agg(F.min("kept").alias("kept"))


def _frequent(sets: DataFrame, limit: int) -> DataFrame:
    """(word, df) of the most frequent words; at most ``limit`` rows."""
    counts = sets.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return counts.orderBy(F.col("df").desc(), "word").limit(limit)


def _prefixes(sets: DataFrame, frequent: DataFrame, overlap: float) -> DataFrame:
    """(author, word, number, size): the words under which each numbered set is found."""
    each = sets.select("number", "author", F.explode("words").alias("word"), F.size("words").alias("size"))
    # Rare words are put in order by a hash.
    order = F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.xxhash64("word").alias("h"), "word")
    ordered = each.join(F.broadcast(frequent), "word", "left").groupBy("number", "author", "size").agg(
        F.array_sort(F.collect_list(order)).alias("words")
    )
    first = F.col("size") - F.ceil(F.lit(overlap) * F.col("size") - 1e-9) + 1
    return ordered.select("author", "number", "size", F.explode(F.slice("words", 1, first.cast("int"))).alias("w")).select(
        "author", F.col("w")["word"].alias("word"), "number", "size"
    )


def _losses(overlap: float) -> list[tuple[int, list[int]]]:
    """(size, places of lost words) of every way in which a short title may lose words."""
    found: list[tuple[int, list[int]]] = []
    for size in range(1, MOST_SHORT + 1):
        most = min(math.floor(size * (1 - overlap) + 1e-6), size - 1)
        if sum(math.comb(size, k) for k in range(most + 1)) > MOST_SETS:
            break
        found += [(size, list(places)) for k in range(most + 1) for places in combinations(range(size), k)]
    return found


def _left(sets: DataFrame, losses: DataFrame) -> DataFrame:
    """Sets with ``left``, a digest of the author and the words that stay, and ``lost``, how many do not."""
    each = sets.join(F.broadcast(losses), F.size("words") == F.col("size"))
    stay = F.filter("words", lambda w, i: ~F.array_contains("places", i))
    # Words hold no line break, so the last one ends the author.
    text = F.concat("author", F.lit("\n"), F.array_join(stay, " "))
    return each.withColumns({"left": F.unhex(F.md5(text.cast("binary"))), "lost": F.size("places")})


def _short_matches(asked: DataFrame, listed: DataFrame, losses: DataFrame, overlap: float) -> DataFrame:
    """(number, kept, share): per set that an asked title leaves and words lost, the smallest listed one.

    The share is that of the set, at most that of the titles, and the same for the set of all
    words that both have; so the greatest share of a title is right, and its smallest ``kept``.
    """
    found = _left(listed, losses).groupBy("left", F.col("lost").alias("_lost")).agg(
        F.min("kept").alias("kept"), F.bool_or(F.col("kept").isNull()).alias("_null")
    )
    common = F.col("size") - F.col("lost")
    share = common / (F.col("size") + F.col("_lost"))
    both = _left(asked, losses).select("number", "left", "lost", "size").join(found, "left").withColumn("share", share)
    return both.where(F.col("share") >= overlap - 1e-9).select("number", F.when(~F.col("_null"), F.col("kept")).alias("kept"), "share")


def _long_matches(asked: DataFrame, listed: DataFrame, short: int, overlap: float, frequent_words: int) -> DataFrame:
    """(number, kept, share) of the pairs of which one title at least has more than ``short`` words."""
    may = F.size("words") >= overlap * (short + 1) - 1e-9
    asked, listed = asked.where(may), listed.where(may)
    frequent = materialise(_frequent(listed, frequent_words), "frequent-words")
    left = _prefixes(asked, frequent, overlap)
    right = _prefixes(listed, frequent, overlap).withColumnsRenamed({"number": "other", "size": "other_size"})
    near = (F.col("other_size") >= F.lit(overlap) * F.col("size") - 1e-9) & (F.col("size") >= F.lit(overlap) * F.col("other_size") - 1e-9)
    long = F.greatest("size", "other_size") > short
    pairs = left.join(right, ["author", "word"]).where(near & long).select("number", "other").distinct()
    both = pairs.join(asked, "number").join(
        listed.select(F.col("number").alias("other"), F.col("words").alias("_words"), "kept"), "other"
    )
    common = F.size(F.array_intersect("words", "_words"))
    share = common / (F.size("words") + F.size("_words") - common)
    return both.withColumn("share", share).where(F.col("share") >= overlap - 1e-9).select("number", "kept", "share")


def title_matches(
    records: DataFrame, index: DataFrame, author: Column, found: str, overlap: float = 0.8, frequent_words: int = FREQUENT_WORDS
) -> DataFrame:
    """(author, words, found, share): for each distinct title of ``records`` the title of
    ``index`` with the greatest overlap of at least ``overlap``, then the smallest ``found``.

    Both tables have a title and what ``author`` reads; the result has the lower-cased author
    and the sorted words of the title asked for, as :func:`with_match` joins them.
    """
    asked = materialise(_sets(records, "title", author, F.lit(0)).drop("kept").withColumn("number", F.monotonically_increasing_id()), "asked")
    listed = materialise(_sets(index, "title", author, F.col(found)).withColumn("number", F.monotonically_increasing_id()), "listed")
    losses = _losses(overlap)
    short = max((size for size, _ in losses), default=0)
    told = F.from_json(F.lit(json.dumps([{"size": n, "places": at} for n, at in losses])), "array<struct<size: int, places: array<int>>>")
    ways = records.sparkSession.range(1).select(F.explode(told).alias("way")).select("way.*")
    scored = _short_matches(asked, listed, ways, overlap).unionByName(_long_matches(asked, listed, short, overlap, frequent_words))
    best = F.min_by(F.struct(F.col("kept").alias(found), "share"), F.struct(-F.col("share"), "kept"))
    return scored.groupBy("number").agg(best.alias("_best")).join(asked, "number").select("author", "words", "_best.*")


def with_match(records: DataFrame, index: DataFrame, author: Column, found: str, overlap: float = 0.8) -> DataFrame:
    """``records`` with the best match's ``found`` and ``share``, null where there is none."""
    matches = title_matches(records, index, author, found, overlap)
    keyed = records.withColumns({"_author": F.lower(author), "_words": F.array_sort(title_words("title"))})
    return keyed.join(
        matches.withColumnsRenamed({"author": "_author", "words": "_words"}), ["_author", "_words"], "left"
    ).drop("_author", "_words")
