"""Graph operators against brute force on small random tables."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from scholarweave.operators import graph
from scholarweave.workspace import materialise


def table(spark, sets):
    rows = [(i, sorted(s)) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "i bigint, w array<string>")
    return graph.publications(df, "i", "w")


def brute_edges(sets):
    return {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if sets[i] & sets[j]}


def brute_degrees(sets):
    degree = dict.fromkeys(range(len(sets)), 0)
    for i, j in brute_edges(sets):
        degree[i] += 1
        degree[j] += 1
    return degree


def brute_components(sets):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in brute_edges(sets):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(len(sets))}


def random_sets(seed, n=60, words=25, most=4):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    sets = [set(rng.sample(vocabulary, rng.randint(0, most))) for _ in range(n)]
    for s in sets[: n // 3]:
        s.add("hot")  # one keyword holds a third of all records
    return sets


def test_degrees(spark):
    sets = random_sets(1)
    got = {r.id: r.degree for r in graph.degrees(table(spark, sets)).collect()}
    assert got == brute_degrees(sets)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sets(st.sampled_from("abcdefg"), max_size=4), min_size=1, max_size=12))
def test_degree_stats_agree_with_the_edge_list(spark, sets):
    stats = graph.degree_stats(table(spark, sets)).first()
    degree = brute_degrees(sets)
    assert stats.publications == len(sets)
    assert stats.edges == len(brute_edges(sets)) == sum(degree.values()) // 2
    assert stats.max_degree == max(degree.values())
    assert stats.mean_degree == pytest.approx(sum(degree.values()) / len(sets))


@pytest.mark.parametrize("lines", [17, 40])
def test_many_common_keywords(spark, lines):
    licence = {f"line {i}" for i in range(lines)}
    sets = [licence | {f"own {i}", f"pair {i // 2}"} for i in range(300)] + [{"pair 0"}, {"alone"}, set()]
    got = {r.id: r.degree for r in graph.degrees(table(spark, sets)).collect()}
    assert got == {i: 299 + (i < 2) for i in range(300)} | {300: 2, 301: 0, 302: 0}


def test_degrees_over_far_apart_ids(spark):
    rows = [(i * 50_000, ["a"] if i % 2 else ["a", "b"]) for i in range(20)]
    pubs = graph.publications(spark.createDataFrame(rows, "i bigint, w array<string>"), "i", "w")
    assert {r.degree for r in graph.degrees(pubs).collect()} == {19}


def test_sampled_edges_of_a_small_table_are_all_edges(spark):
    sets = random_sets(2, n=40)
    got = {(r.src, r.dst) for r in graph.sampled_edges(table(spark, sets)).collect()}
    assert got == brute_edges(sets)


def test_components(spark):
    sets = random_sets(3, n=50, words=80, most=2)
    got = {r.id: r.component for r in graph.components(table(spark, sets)).collect()}
    assert got == brute_components(sets)


def test_components_of_a_long_chain(spark):
    sets = [{f"k{i}", f"k{i + 1}"} for i in range(40)]
    rng = random.Random(5)
    rng.shuffle(sets)
    got = graph.components(table(spark, sets)).select("component").distinct().collect()
    assert [r.component for r in got] == [0]


def test_levels(spark, monkeypatch):
    monkeypatch.setattr(graph, "COMPACT_EVERY", 2)
    sets = [{f"k{i}", f"k{i + 1}"} for i in range(6)] + [{"z"}]
    members = materialise(graph.memberships(table(spark, sets)), "m")
    seeds = spark.createDataFrame([(0,)], "id bigint")
    got = {r.id: r.level for r in graph.bfs_levels(members, seeds).collect()}
    assert got == {i: i for i in range(6)}
    near = {r.id for r in graph.bfs_levels(members, seeds, max_hops=2).collect()}
    assert near == {0, 1, 2}


def test_degrees_of_repeated_publications(spark):
    """Every row twice: keywords of different publications are still told apart."""
    sets = random_sets(8, n=40, words=30, most=6) + [{"p"}, {"p"}, {"q"}, {"q"}, {"r"}, {"r"}]
    twice = table(spark, sets).union(table(spark, sets))
    got = {r.id: r.degree for r in graph.degrees(twice).collect()}
    assert got == brute_degrees(sets)


def test_degrees_of_many_frequent_keywords(spark):
    rng = random.Random(9)
    sets = [{f"w{k}" for k in range(12) if rng.random() < 1 / (k + 2)} | {f"pair {i // 2}"} for i in range(400)]
    got = {r.id: r.degree for r in graph.degrees(table(spark, sets)).collect()}
    assert got == brute_degrees(sets)


def test_levels_over_shared_memberships(spark):
    """Long lines are hopped over as digests, equal ones as one, those of one publication not at all."""
    sets = [{f"k{i}" * 500, f"k{i + 1}" * 500, f"l{i + 1}", f"own {i}"} | ({f"l{i}"} if i else set()) for i in range(6)] + [{"z"}]
    pubs = table(spark, sets)
    members = graph.shared_memberships(pubs)
    assert members.count() == 10 and {len(r.keyword) for r in members.collect()} == {16}
    seeds = spark.createDataFrame([(0,), (6,)], "id bigint")
    levels = lambda m: {r.id: r.level for r in graph.bfs_levels(m, seeds).collect()}
    assert levels(members) == levels(materialise(graph.memberships(pubs), "m")) == {i: i for i in range(6)} | {6: 0}
