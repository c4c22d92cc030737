"""Communities of publications that share keywords.

The graph stays in its compact form, the membership table (id, keyword). A community is
a set of publications together with the keywords that are more theirs than chance would
have it: the modularity of the two-sided graph,

    Q = sum over communities of (e / m - K * D / m^2)

with m memberships, e of them inside the community, K those of its publications and D
those of its keywords. A keyword that everything has adds nothing to any community.

A round lets every keyword take the best community given those of the publications, then
every publication the best one given those of the keywords. Given one side, the choices
of the other do not depend on each other, so all are made at once and Q never falls.
Where no publication moves, communities merge, and the rounds go on; all ends where
neither changes anything. Of two communities that are each other's best partner, the one
that more others want takes in all that want it, as far as their gains outweigh the most
they can lose among each other, else its partner alone. So Q rises, and a community with
very many small ones around it takes them in together.
All sums are whole numbers, so the result depends on no order.

Keywords with the same publications always choose alike, so they are one with a weight. A
keyword of one publication follows it: such keywords are a number beside the publication,
and a publication that has no others is alone and takes no part in the rounds.

Work and tables of a round grow with what is left of the memberships: counts per (keyword,
community) and (publication, community), never pairs of publications. Keywords are shuffled
as digests. Labels are written after every round; the driver sees one count a round.

Defined results: equal gains are decided for the present community, then for the smallest
number. A publication whose best gain is below zero, or that has no keyword, is alone.
Communities are named by their smallest publication. Repeated publications are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scholarweave.operators.graph import HOLDERS, hashed_memberships, holders
from scholarweave.workspace import materialise

WHOLE = "decimal(19,0)"  # products of two counts fit in 38 digits


def _gain(inside: str, m: int, own: str, others: str) -> Column:
    """m^2 times what the modularity wins by this choice."""
    whole = lambda c: c.cast(WHOLE)
    return whole(F.col(inside)) * whole(F.lit(m)) - whole(F.col(own)) * whole(F.col(others))


def _weighted(pubs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(id, keyword, k, d, w), (id, k, own), and the number of memberships m.

    The memberships are those of the keywords of several publications: k is the number of all
    keywords of the publication, d that of the publications of the keyword, and w that of the
    keywords it stands for. ``own`` is the number of the keywords that only the publication has.
    """
    found = materialise(hashed_memberships(pubs).distinct(), "members")
    same = (
        holders(found).groupBy(*HOLDERS).agg(F.min("keyword").alias("keyword"), F.count(F.lit(1)).alias("w"))
        .select("keyword", F.col("n").alias("d"), "w")
    )
    merged = materialise(found.join(same, "keyword"), "merged-members")
    per_pub = merged.groupBy("id").agg(F.sum("w").alias("k"), F.sum(F.when(F.col("d") == 1, F.col("w")).otherwise(0)).alias("own"))
    vertices = materialise(per_pub, "vertices")
    members = materialise(merged.where("d > 1").join(vertices.select("id", "k"), "id").select("id", "keyword", "k", "d", "w"), "members")
    return members, vertices, vertices.agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]


def _word_sizes(words: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """(label, memberships of its keywords), those of single publications included."""
    shared = words.select("label", (F.col("d") * F.col("w")).alias("n"))
    single = labels.where("label IS NOT NULL AND own > 0").select("label", F.col("own").alias("n"))
    return shared.unionByName(single).groupBy("label").agg(F.sum("n").alias(name))


def _keyword_choice(members: DataFrame, labels: DataFrame, m: int) -> DataFrame:
    """(keyword, label, d, w): the community of every keyword that is not worse off in one.

    ``members`` is (id, keyword, k, d, w), ``labels`` (id, label, k, own).
    """
    sizes = labels.where("label IS NOT NULL").groupBy("label").agg(F.sum("k").alias("size"))
    counts = (
        members.select("id", "keyword", "d", "w").join(labels.where("label IS NOT NULL").select("id", "label"), "id")
        .groupBy("keyword", "label").agg(F.count(F.lit(1)).alias("n"), F.first("d").alias("d"), F.first("w").alias("w"))
    )
    rated = counts.join(sizes, "label").withColumn("gain", _gain("n", m, "d", "size")).where("gain >= 0")
    best = F.max_by(F.struct("label", "d", "w"), F.struct("gain", -F.col("label")))
    return rated.groupBy("keyword").agg(best.alias("b")).select("keyword", "b.*")


def _publication_choice(members: DataFrame, labels: DataFrame, words: DataFrame, m: int) -> DataFrame:
    """(id, label, k, own, moved): the community of every publication, given those of the keywords."""
    sizes = _word_sizes(words, labels, "size")
    shared = members.select("id", "keyword", "k", "w").join(words.select("keyword", "label"), "keyword").select("id", "label", "k", "w")
    single = labels.where("label IS NOT NULL AND own > 0").select("id", "label", "k", F.col("own").alias("w"))
    counts = shared.unionByName(single).groupBy("id", "label").agg(F.sum("w").alias("n"), F.first("k").alias("k"))
    rated = counts.join(sizes, "label").withColumn("gain", _gain("n", m, "k", "size")).where("gain >= 0").select("id", "label", "gain")
    old = labels.select("id", F.col("label").alias("old"), "k", "own")
    rank = F.struct("gain", F.col("label").eqNullSafe(F.col("old")), -F.col("label"))
    chosen = (
        old.join(rated, "id", "left").groupBy("id")
        .agg(F.max_by("label", rank).alias("label"), F.first("old").alias("old"), F.first("k").alias("k"), F.first("own").alias("own"))
    )
    return chosen.select("id", "label", "k", "own", (~F.col("label").eqNullSafe(F.col("old"))).alias("moved"))


def _merges(members: DataFrame, labels: DataFrame, words: DataFrame, m: int) -> DataFrame:
    """(label, target) of communities that go up in another one, all at once, so that Q rises."""
    ends = (
        members.select("id", "keyword", "w").join(labels.select("id", "label"), "id")
        .join(words.select("keyword", F.col("label").alias("word_label")), "keyword").where("label <> word_label")
    )
    low, high = F.least("label", "word_label"), F.greatest("label", "word_label")
    between = ends.groupBy(low.alias("a"), high.alias("b")).agg(F.sum("w").alias("n"))
    of_pubs = labels.where("label IS NOT NULL").groupBy("label").agg(F.sum("k").alias("size_k"))
    of_words = _word_sizes(words, labels, "size_d")
    sizes = of_pubs.join(of_words, "label", "full").na.fill(0, ["size_k", "size_d"])
    named = lambda end: sizes.select(
        F.col("label").alias(end), F.col("size_k").alias(f"k_{end}"), F.col("size_d").alias(f"d_{end}")
    )
    product = lambda x, y: F.col(x).cast(WHOLE) * F.col(y).cast(WHOLE)
    expected = product("k_a", "d_b") + product("k_b", "d_a")
    gain = F.col("n").cast(WHOLE) * F.lit(m).cast(WHOLE) - expected
    pairs = between.join(named("a"), "a").join(named("b"), "b").withColumn("gain", gain).where("gain > 0")
    # One order of pairs for both ends, so best partners lead to pairs that are each other's best.
    sides = F.array(F.struct(F.col("a").alias("end"), F.col("b").alias("partner")), F.struct(F.col("b").alias("end"), F.col("a").alias("partner")))
    sided = pairs.select(F.explode(sides).alias("s"), "a", "b", "gain").select("s.*", "a", "b", "gain")
    chosen = F.max_by(F.struct("partner", "gain", "a", "b"), F.struct("gain", -F.col("a"), -F.col("b")))
    best = materialise(sided.groupBy("end").agg(chosen.alias("c")).select("end", "c.*"), "best-partners")
    liked = best.groupBy(F.col("partner").alias("end")).agg(F.count(F.lit(1)).alias("liked"))
    # The end that more communities want stays; those that want it come to it.
    root = F.max_by("end", F.struct("liked", -F.col("end")))
    roots = (
        best.join(liked, "end").groupBy("a", "b").agg(F.count(F.lit(1)).alias("ends"), root.alias("root")).where("ends = 2")
        .select("root", (F.col("a") + F.col("b") - F.col("root")).alias("mate"))
    )
    leaves = best.select("end", F.col("partner").alias("root"), "gain").join(roots, "root").join(sizes.withColumnRenamed("label", "end"), "end")
    # What the arrivals at one root may lose among each other is at most size_k times the others' size_d.
    arriving = leaves.groupBy("root").agg(F.sum("size_d").alias("all_d"))
    loss = F.col("size_k").cast(WHOLE) * (F.col("all_d") - F.col("size_d")).cast(WHOLE)
    rated = materialise(leaves.join(arriving, "root").select("end", "root", "mate", (F.col("gain") > loss).alias("ok")), "arrivals")
    some = rated.groupBy("root").agg(F.bool_or("ok").alias("some"))
    taken = rated.join(some, "root").where("ok OR (NOT some AND end = mate)")
    return taken.select(F.col("end").alias("label"), F.col("root").alias("target"))


def communities(pubs: DataFrame) -> DataFrame:
    """(id, community) of every publication (id, keywords)."""
    members, vertices, m = _weighted(pubs)
    # The others have no keyword that another publication has.
    linked = vertices.where("own < k").select("id", F.col("id").alias("label"), "k", "own")
    labels = materialise(linked, "labels")
    while True:
        words = materialise(_keyword_choice(members, labels, m), "keyword-labels")
        after = materialise(_publication_choice(members, labels, words, m), "labels")
        labels = after.drop("moved")
        if not after.where("moved").isEmpty():
            continue
        merges = _merges(members, labels, words, m)
        merged = labels.join(merges, "label", "left").select("id", F.coalesce("target", "label").alias("label"), "k", "own", F.col("target").isNotNull().alias("moved"))
        after = materialise(merged, "labels")
        if after.where("moved").isEmpty():
            break
        labels = after.drop("moved")
    names = labels.where("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("community"))
    named = labels.join(names, "label").select("id", "community")
    return (
        pubs.select("id").distinct().join(named, "id", "left")
        .select("id", F.coalesce("community", "id").alias("community"))
    )


def modularity(pubs: DataFrame, assigned: DataFrame) -> DataFrame:
    """One row (communities, modularity): how good an assignment (id, community) is.

    Every keyword counts for the community that gains most by it.
    """
    members, vertices, m = _weighted(pubs)
    labels = materialise(vertices.join(assigned.withColumnRenamed("community", "label"), "id"), "labels")
    words = _keyword_choice(members, labels, m).select("keyword", "label", "d", "w")
    sizes = labels.groupBy("label").agg(F.sum("k").alias("size"))
    shared = members.join(labels.select("id", "label"), "id").join(words.select("keyword", "label"), ["keyword", "label"]).select("label", "w")
    single = labels.select("label", F.col("own").alias("w"))
    inside = shared.unionByName(single).groupBy("label").agg(F.sum("w").alias("e"))
    held = _word_sizes(words, labels, "held")
    share = F.col("e") / F.lit(m) - F.col("size") / F.lit(m) * (F.col("held") / F.lit(m))
    shares = held.join(sizes, "label").join(inside, "label").select(F.lit(None).cast("bigint").alias("community"), share.alias("share"))
    rows = shares.unionByName(assigned.select("community", F.lit(0.0).alias("share")))
    return rows.agg(
        F.count_distinct("community").alias("communities"), F.coalesce(F.sum("share"), F.lit(0.0)).alias("modularity")
    )
