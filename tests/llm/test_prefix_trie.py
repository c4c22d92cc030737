import hashlib
import math
import random
import zlib

import pytest

from scholarweave.llm import prefix_trie as P, queries
from tests.llm.conftest import SMALL

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows):
    """Turns of each conversation in order; turns of one number go by the hash, given as rows are."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((-math.inf if turn is None else turn, role or "", text or ""))
    return {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


def brute_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += own
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(convs[c]) == len(node)))
        out.append((
            min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), kids.get(node, 0), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def table(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "1 AS place", "'x' AS a", "0 AS depth", "2 AS n", "3 AS length", "'r' AS state")


def collected(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=repr)


def test_whole_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(queries.QUERIES["op11_prefix_trie"](spark, SMALL)) == brute_trie(rebuilt(sequences(rows)))


def test_awkward_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "hi"), (1, 1, "", "é\n"), (2, 0, "user", "hi"), (2, 5, None, "é\n"), (3, 0, "u", "x" * 100_000),
        (5, 0, "user", "hi"), (5, 1, "user", "hi"), (5, 2, "user", "hi"), (6, 0, "us", "erhi"), (-4, 0, "user", "hi"), (-7, 3, "a", ""),
        (None, 0, "user", "hi"), (9, 0, "user", "hi"), (9, 0, "user", "hi"), (2**53 + 1, 0, "user", "hi"), (2**53, 0, "user", "hi"),
        (0, 0, "user", "hi"), (10, -1, "user", "hi"), (11, 0, "user", "hi"), (12, 0, "user", "hi"), (13, 0, "user", "hi"), (14, 0, "b", "c"),
    ]
    turns = P.numbered_turns(table(spark, rows))
    assert collected(P.trie(*turns)) == brute_trie(sequences(rows))
    assert collected(P.trie(*P.shared_beginnings(*turns))) == brute_trie(rebuilt(sequences(rows)))


def test_long_chains_hot_nodes_and_repeated_conversations(spark, monkeypatch):
    monkeypatch.setattr(P, "PART_BITS", 3)
    monkeypatch.setattr(P, "PAGE_BITS", 2)
    rng = random.Random(3)
    rows = [(c, t, "u", f"turn {t}") for c in (0, 1) for t in range(60 - 20 * c)]
    rows += [(c, 0, "u", f"own {c}") for c in range(20, 80)]
    rows += [(c, t, "u", "same") for c in range(100, 130) for t in range(3)]
    rows += [(c, t, "u", rng.choice("ab")) for c in range(200, 240) for t in range(rng.randrange(1, 12))]
    turns = P.numbered_turns(table(spark, rows).repartition(5))
    assert collected(P.trie(*turns)) == brute_trie(sequences(rows))
    assert collected(P.trie(*P.shared_beginnings(*turns))) == brute_trie(rebuilt(sequences(rows)))


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "hi")]])
def test_empty_table(spark, rows):
    turns = P.numbered_turns(table(spark, rows))
    assert P.trie(*P.shared_beginnings(*turns)).collect() == []


def test_ties_do_not_depend_on_the_layout(spark):
    rows = [(c, c % 2, "u", f"{c} {i % 7}") for c in range(6) for i in range(20)]
    first, second = (collected(P.trie(*P.numbered_turns(table(spark, rows).repartition(n)))) for n in (1, 6))
    assert first == second


def test_rounds_grow_with_the_logarithm_of_the_depth(spark, monkeypatch):
    """A chain of 300 nodes below a wide root is contracted in a few tens of rounds."""
    written = []
    materialise = P.materialise
    monkeypatch.setattr(P, "materialise", lambda df, label: written.append(label) or materialise(df, label))
    rows = [(0, t, "u", "x") for t in range(300)] + [(c, 0, "u", f"{c}") for c in range(1, 50)]
    assert collected(P.trie(*P.numbered_turns(table(spark, rows)))) == brute_trie(sequences(rows))
    assert written.count("contracted") < 40
