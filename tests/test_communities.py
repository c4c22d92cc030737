"""Communities against a plain version, a planted partition and edge cases."""

import random
from collections import Counter

from scholarweave.operators import communities as C
from tests.test_graph import random_sets, table


def plain(sets):
    """The same rules over dictionaries."""
    members = [(i, w) for i, s in enumerate(sets) for w in s]
    m, k, d = len(members), Counter(i for i, _ in members), Counter(w for _, w in members)
    label = {i: i for i in k}

    def choose(own, size, counts, old=None):
        rated = [(n * m - own * size[c], c == old, -c) for c, n in counts.items()]
        rated = [r for r in rated if r[0] >= 0]
        return -max(rated)[2] if rated else None

    def totals(labels, weights):
        size = Counter()
        for x, c in labels.items():
            if c is not None:
                size[c] += weights[x]
        return size

    while True:
        size_k = totals(label, k)
        near = {w: Counter() for w in d}
        for i, w in members:
            if label[i] is not None:
                near[w][label[i]] += 1
        word = {w: choose(d[w], size_k, near[w]) for w in d}
        size_d = totals(word, d)
        near = {i: Counter() for i in k}
        for i, w in members:
            if word[w] is not None:
                near[i][word[w]] += 1
        after = {i: choose(k[i], size_d, near[i], label[i]) for i in k}
        if after != label:
            label = after
            continue
        size_k, between = totals(label, k), Counter()
        for i, w in members:
            a, b = label[i], word[w]
            if a is not None and b is not None and a != b:
                between[min(a, b), max(a, b)] += 1
        best = {}
        for (a, b), n in between.items():
            gain = n * m - size_k[a] * size_d[b] - size_k[b] * size_d[a]
            if gain > 0:
                for end in (a, b):
                    best[end] = max(best.get(end, (0, 0, 0)), (gain, -a, -b))
        partner = {end: -a - b - end for end, (_, a, b) in best.items()}
        liked, target = Counter(partner.values()), {}
        for x, y in partner.items():
            if partner[y] != x or (liked[x], -x) < (liked[y], -y):
                continue
            leaves = [z for z in partner if partner[z] == x]  # x stays
            d_all = sum(size_d[z] for z in leaves)
            fit = [z for z in leaves if best[z][0] > size_k[z] * (d_all - size_d[z])]
            target.update({z: x for z in fit or [y]})
        if not target:
            break
        label = {i: target.get(c, c) for i, c in label.items()}
    smallest = {}
    for i in sorted(label):
        smallest.setdefault(label[i], i)
    return {i: smallest[label[i]] if label.get(i) is not None else i for i in range(len(sets))}


def found(spark, sets):
    return {r.id: r.community for r in C.communities(table(spark, sets)).collect()}


def test_as_plain(spark):
    sets = random_sets(3)
    assert found(spark, sets) == plain(sets)


def test_planted_partition(spark):
    rng = random.Random(5)
    sets = [
        {f"g{i % 4}-{w}" for w in rng.sample(range(12), 5)} | {f"g{rng.randrange(4)}-{rng.randrange(12)}", "common"}
        for i in range(80)
    ]
    got = found(spark, sets)
    assert {i: c for i, c in got.items()} == {i: i % 4 for i in range(80)}


def test_copies_alone_and_empty(spark):
    sets = [{"a", "b"}, {"a", "b"}, set(), {"x"}, {"x"}, {"y"}]
    assert found(spark, sets) == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3, 5: 5}
    assert C.communities(table(spark, [{"q"}]).where("id < 0")).count() == 0


def test_one_keyword_is_one_community(spark):
    assert found(spark, [{"one"}] * 4) == dict.fromkeys(range(4), 0)


def test_modularity(spark):
    sets = [{"a", "b"}, {"a", "b"}, {"c", "d"}, {"c", "d"}]
    pubs = table(spark, sets)
    good = C.modularity(pubs, C.communities(pubs)).first()
    assert good.communities == 2 and abs(good.modularity - 0.5) < 1e-12
    one = pubs.selectExpr("id", "0L AS community")
    assert abs(C.modularity(pubs, one).first().modularity) < 1e-12


def test_keywords_with_equal_publications_are_one(spark):
    """40 lines that all have and 50 that one has: a row each, not 90."""
    sets = [{f"line {k}" for k in range(40)} | {f"own {i} {k}" for k in range(50)} | {f"pair {i // 2}"} for i in range(30)]
    pubs = table(spark, sets)
    members, vertices, m = C._weighted(pubs)
    assert m == 30 * 91 and members.count() == 60
    assert {(r.k, r.own) for r in vertices.collect()} == {(91, 50)}
    assert found(spark, sets) == plain(sets)
