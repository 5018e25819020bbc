"""Connected components against union-find, and the number of rounds of long chains."""

import random

from marketloom.llm.components import connected_components


def brute(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def run(spark, edges):
    told = []
    out = connected_components(spark.createDataFrame(edges, "a long, b long"), report=lambda *x: told.append(x))
    rows = out.collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}, told[0]


def test_long_chains(spark):
    n = 10_000
    got, (rounds, jumps) = run(spark, [(i, i + 1) for i in range(n)])
    assert set(got.values()) == {0} and len(got) == n + 1
    assert rounds + jumps <= 20


def test_shuffled_chain_star_and_random(spark):
    rng = random.Random(5)
    ids = list(range(2_000))
    rng.shuffle(ids)
    edges = list(zip(ids, ids[1:]))  # a chain in random order
    edges += [(5_000, 5_000 + i) for i in range(-300, 300) if i]  # a star around a middle id
    edges += [(rng.randrange(6_000, 7_000), rng.randrange(6_000, 7_000)) for _ in range(900)]
    edges += [(8_000 + (i & (i - 1)), 8_000 + i) for i in range(1, 256)] + [(9, 9), (8_255, 8_000)]
    edges += [(b, a) for a, b in edges[:50]]
    got, (rounds, jumps) = run(spark, edges)
    want = brute([(a, b) for a, b in edges if a != b])
    assert got == want
    assert rounds <= 8


def test_no_edges(spark):
    assert run(spark, [(3, 3)])[0] == {}
    out = connected_components(spark.createDataFrame([], "a long, b long"))
    assert out.columns == ["node", "component"] and out.count() == 0
