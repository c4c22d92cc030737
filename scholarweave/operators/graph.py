"""Publications linked by shared keywords.

Two publications are neighbours when they share a keyword. A keyword of k
publications stands for k(k-1)/2 such pairs, so the graph is kept in its compact
form, the membership table (id, keyword), which says the same and grows with the
input only. Degrees, levels and components are computed from memberships without
listing pairs; pairs are listed for a sample of fixed size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholarweave.functions.text import ColumnOrName, col
from scholarweave.operators.ordered import sample_n
from scholarweave.workspace import materialise

COMPACT_EVERY = 10


def publications(df: DataFrame, key: ColumnOrName, words: ColumnOrName) -> DataFrame:
    """(id, keywords): the vertices, with sorted distinct non-blank keywords."""
    cleaned = F.array_sort(F.array_distinct(F.filter(col(words), lambda k: k != "")))
    empty = F.array().cast("array<string>")
    return df.select(
        col(key).cast("bigint").alias("id"), F.coalesce(cleaned, empty).alias("keywords")
    )


def memberships(pubs: DataFrame) -> DataFrame:
    """(id, keyword): the compact edge table."""
    return pubs.select("id", F.explode("keywords").alias("keyword"))


def keyword_groups(members: DataFrame) -> DataFrame:
    """Per keyword its publications and the pairs it stands for."""
    n = F.count(F.lit(1))
    return members.groupBy("keyword").agg(
        n.alias("publications"), F.expr("count(1) * (count(1) - 1) div 2").alias("pairs")
    )


def sampled_edges(pubs: DataFrame, n: int = 150, seed: int = 42) -> DataFrame:
    """All pairs src < dst sharing a keyword within an exact sample of ``n`` publications.

    The join meets on keywords and sees at most ``n`` publications.
    """
    members = memberships(sample_n(pubs, "id", n, seed))
    other = members.select(F.col("id").alias("dst"), "keyword")
    pairs = members.withColumnRenamed("id", "src").join(other, "keyword")
    return pairs.where("src < dst").select("src", "dst").distinct()


def edge_degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Degree of every vertex in a listed edge table; isolated ones get 0."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    counts = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    return vertices.select("id").join(counts, "id", "left").na.fill(0, ["degree"])


def hashed_memberships(pubs: DataFrame) -> DataFrame:
    """(id, keyword) with a digest of 128 bits for each keyword, which may be a long text."""
    return pubs.select("id", F.explode(F.transform("keywords", lambda k: F.unhex(F.md5(k.cast("binary"))))).alias("keyword"))


#: What says which publications a keyword has.
HOLDERS = ("n", "h0", "h1", "h2", "h3")


def holders(members: DataFrame) -> DataFrame:
    """(keyword, n, h0 to h3): the number of a keyword's publications, and sums of four digests of 32 bits.

    Sums tell repeated publications apart, which would cancel each other out in a bitwise one.
    """
    halves = [F.shiftright(F.xxhash64("id", *salt), 32) for salt in ([], [F.lit(1)], [F.lit(2)], [F.lit(3)])]
    sums = [F.sum(half).alias(name) for name, half in zip(HOLDERS[1:], halves)]
    return members.groupBy("keyword").agg(F.count(F.lit(1)).alias(HOLDERS[0]), *sums)


def shared_memberships(pubs: DataFrame) -> DataFrame:
    """(id, keyword) with keywords that occur in exactly the same publications made one.

    A licence text of many lines is then one keyword. Which publications a keyword has
    is told by their number and digests of 128 bits over their ids. Keywords of a
    single publication link nothing and are left out. The table is stored.
    """
    members = hashed_memberships(pubs)
    same = holders(members).where("n > 1").groupBy(*HOLDERS).agg(F.min("keyword").alias("keyword")).select("keyword")
    return materialise(members.join(same, "keyword", "left_semi"), "shared-keywords")


#: Ids of one row in the sets of ids that are united for degrees.
BITS = 64


def class_degrees(pubs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Degrees per set of shared keywords: (id, cls), and (cls, n publications, degree each).

    Publications with the same shared keywords have the same neighbours, so they form a
    class. The publications of a keyword are kept as rows with the bits of 64 ids each, so a
    keyword of few publications takes few rows. Those of a class's two most frequent keywords
    are counted by the numbers of each and of both, once for all classes with these two. Only
    the rarer ones of a class are listed, united, and counted where neither of the two has
    them. Publications that share no keyword are in no class.
    """
    members = shared_memberships(pubs)
    owners = materialise(
        members.groupBy("id").agg(F.xxhash64(F.array_sort(F.collect_list("keyword"))).alias("cls")), "classes"
    )
    sizes = owners.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    words = members.join(sizes.select("id", "cls"), "id").select("cls", "keyword")
    bit = F.expr(f"shiftleft(1L, CAST(pmod(id, {BITS}) AS INT))")
    bits = members.groupBy("keyword", F.floor(F.col("id") / BITS).alias("bucket")).agg(F.bit_or(bit).alias("bits"))
    maps = materialise(bits, "keyword-ids")
    counts = maps.groupBy("keyword").agg(F.sum(F.bit_count("bits")).alias("n"))
    falling = F.sort_array(F.collect_list(F.struct("n", "keyword")), asc=False)
    listed = words.join(counts, "keyword").groupBy("cls").agg(falling.alias("w"))
    first, second = F.get("w", F.lit(0)), F.get("w", F.lit(1))
    classes = materialise(
        listed.select(
            "cls", first["keyword"].alias("k1"), second["keyword"].alias("k2"), first["n"].alias("n1"), second["n"].alias("n2"),
            F.slice(F.col("w")["keyword"], F.lit(3), F.size("w")).alias("rest"),
        ),
        "class-keywords",
    )
    of = lambda key, found: maps.select(F.col("keyword").alias(key), "bucket", F.col("bits").alias(found))
    both = (
        classes.where("k2 IS NOT NULL").select("k1", "k2").distinct().join(of("k2", "b2"), "k2").join(of("k1", "b1"), ["k1", "bucket"])
        .groupBy("k1", "k2").agg(F.sum(F.bit_count(F.col("b1").bitwiseAND(F.col("b2")))).alias("common"))
    )
    rarer = (
        classes.select("cls", "k1", "k2", F.explode("rest").alias("keyword")).join(maps, "keyword")
        .groupBy("cls", "k1", "k2", "bucket").agg(F.bit_or("bits").alias("bits"))
        .join(of("k1", "b1"), ["k1", "bucket"], "left").join(of("k2", "b2"), ["k2", "bucket"], "left")
    )
    fresh = F.expr("bit_count(bits & ~coalesce(b1, 0L) & ~coalesce(b2, 0L))")
    more = rarer.groupBy("cls").agg(F.sum(fresh).alias("more"))
    degree = F.col("n1") + F.coalesce("n2", F.lit(0)) - F.coalesce("common", F.lit(0)) + F.coalesce("more", F.lit(0)) - 1
    reached = classes.join(both, ["k1", "k2"], "left").join(more, "cls", "left").select("cls", degree.alias("degree"))
    return owners, sizes.select("cls", "n").join(reached, "cls")


def degrees(pubs: DataFrame) -> DataFrame:
    """(id, degree) of every publication; those without shared keywords get 0."""
    owners, per_class = class_degrees(pubs)
    linked = owners.join(per_class, "cls").select("id", "degree")
    return pubs.select("id").join(linked, "id", "left").na.fill(0, ["degree"])


def degree_stats(pubs: DataFrame) -> DataFrame:
    """Publications, edges, mean and largest degree of the whole graph."""
    _, per_class = class_degrees(pubs)
    every = pubs.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("ends"), F.lit(0).cast("bigint").alias("degree"))
    rows = every.unionByName(per_class.select(F.lit(0).alias("n"), (F.col("n") * F.col("degree")).alias("ends"), "degree"))
    return rows.agg(
        F.sum("n").alias("publications"),
        (F.sum("ends") / 2).cast("bigint").alias("edges"),
        (F.sum("ends") / F.sum("n")).alias("mean_degree"),
        F.max("degree").alias("max_degree"),
    )


def bfs_levels(members: DataFrame, seeds: DataFrame, max_hops: int | None = None) -> DataFrame:
    """(id, level): hops from the seed publications over shared keywords.

    A hop goes from publications to their keywords and on to the publications of
    those. Memberships of keywords that have been used are dropped, so each hop works
    on what is left and a publication that has been expanded never comes back.
    ``members`` should be a stored table; what is found is written after every hop.
    """
    frontier = materialise(seeds.select("id", F.lit(0).alias("level")).distinct(), "bfs")
    visited, level = frontier, 0
    while not frontier.isEmpty() and (max_hops is None or level < max_hops):
        level += 1
        known = frontier.select("id")
        words = materialise(members.join(known, "id", "left_semi").select("keyword").distinct(), "bfs-words")
        reached = members.join(words, "keyword", "left_semi").select("id").distinct()
        frontier = materialise(
            reached.join(known, "id", "left_anti").select("id", F.lit(level).alias("level")), "bfs"
        )
        members = materialise(members.join(words, "keyword", "left_anti"), "bfs-left")
        visited = visited.unionByName(frontier)
        if level % COMPACT_EVERY == 0:  # keeps the plan of a deep search short
            visited = materialise(visited, "bfs")
    return visited


def components(pubs: DataFrame) -> DataFrame:
    """(id, component): connected publications share the smallest id among them."""
    linked = linked_components(materialise(memberships(pubs), "members"))
    return pubs.select("id").join(linked, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def linked_components(members: DataFrame) -> DataFrame:
    """(id, component) of the ids that share a keyword with a smaller one of their component.

    Every keyword first becomes a star around its smallest publication, which
    connects the same vertices as all its pairs would. Large-star and small-star
    steps then shorten paths until nothing changes, in a number of rounds that
    grows with the logarithm of the graph. Joins are to one row for each vertex; a
    vertex with a large share of the edges is left to adaptive execution to split.
    ``members`` (id, keyword) should be a stored table; a keyword of one row links nothing.
    """
    stars = members.groupBy("keyword").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("n"))
    star = members.join(stars.where("n > 1").select("keyword", "v"), "keyword")
    edges = materialise(
        star.where("id <> v").select(F.col("id").alias("u"), "v").distinct(), "star"
    )
    before, now = None, _fingerprint(edges)
    while now != before:
        larger = materialise(_large_star(edges), "star")
        edges = materialise(_small_star(larger), "star")
        before, now = now, _fingerprint(edges)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    """Size and order-free digest of a set of edges."""
    digests = [F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))]
    return tuple(edges.agg(F.count(F.lit(1)), *digests).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex to the vertex's smallest neighbour.

    Links may repeat; they are no more than the edges, and the step that follows drops repeats.
    """
    both = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("u").alias("u"), F.col("v").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("u").alias("v")),
            )
        ).alias("e")
    ).select("e.*")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a vertex and its smaller neighbours to the smallest of them.

    Edges point from the larger vertex ``u`` to the smaller ``v``.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    neighbours = edges.join(least, "u").select(F.col("v").alias("u"), "m")
    linked = neighbours.unionByName(least.select("u", "m")).where("u <> m")
    return linked.select("u", F.col("m").alias("v")).distinct()
