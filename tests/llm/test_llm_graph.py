import random

import numpy as np
import pytest

from ledgerflow.llm import graph
from ledgerflow.llm.graph import components, least_of_components


def brute(edges):
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {i: root(i) for i in up}


def shapes():
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(700)]
    hub = [(10_000, 10_001 + i) for i in range(700)]
    ids = rng.sample(range(50_000, 90_000), 400)
    mixed = list(zip(ids, ids[1:]))[:250] + [(rng.choice(ids), rng.choice(ids)) for _ in range(60)]
    return chain + hub + mixed + [(5, 5), (99_999, 99_999), (3, 2), (2, 3), (-7, 2 ** 62)]


@pytest.mark.parametrize("contracted", [1_000_000, 60, 1])
def test_components_against_brute_force(spark, monkeypatch, contracted):
    """All edges in one task, or rounds of stars."""
    monkeypatch.setattr(graph, "CONTRACTED", contracted)
    edges = shapes()
    random.Random(1).shuffle(edges)
    got = components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["root"] for r in got} == brute(edges)


def test_no_edges(spark):
    assert components(spark.createDataFrame([(4, 4)], "u long, v long")).count() == 0


def test_roots_of_random_graphs():
    rng = np.random.default_rng(2)
    for n in (1, 2, 30, 500):
        for m in (1, n // 2 + 1, 2 * n):
            u, v = rng.integers(-n, n, m), rng.integers(-n, n, m)
            nodes, root = least_of_components(u, v)
            want = brute([(int(a), int(b)) for a, b in zip(u, v)])
            assert all(want.get(int(a), int(a)) == int(b) for a, b in zip(nodes, root))


@pytest.mark.parametrize("edges", ["chain", "hub"])
def test_a_chain_and_a_hub_take_few_jobs(spark, edges):
    rows = [(i, i + 1) if edges == "chain" else (0, i + 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "u long, v long").repartition(8)
    sc = spark.sparkContext
    sc.setJobGroup(f"graph-{edges}", "components")
    out = components(df)
    sc.setJobGroup("", "")
    assert len(sc.statusTracker().getJobIdsForGroup(f"graph-{edges}")) <= 10
    assert {r["root"] for r in out.select("root").distinct().collect()} == {0} and out.count() == 3001
