import numpy as np
import pytest
from llm_cases import awkward_rows, brute_components, edited, prose, shingles, table

from ledgerflow.llm import jaccard
from ledgerflow.llm.jaccard import band_edges, linked, ngram_components, scheme, signatures, without_near_copies


@pytest.mark.parametrize("num", [80, 90])
def test_similar_sets_share_enough_signatures(num):
    rng = np.random.default_rng(num)
    tried = 0
    for t in range(3000):
        n = int(rng.integers(1, 400 if t % 2 else 40))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        change = int(rng.integers(0, max(2, len(a) // 4)))
        gone = int(rng.integers(0, change + 1))
        b = np.unique(np.concatenate((rng.permutation(a)[:max(0, len(a) - gone)], rng.integers(0, 1 << 62, change - gone).astype(np.uint64))))
        inter = len(np.intersect1d(a, b))
        if not len(b) or 100 * inter < num * (len(a) + len(b) - inter):
            continue
        tried += 1
        small, large = sorted((len(a), len(b)))
        edges = band_edges(large)
        band = int(np.searchsorted(edges, small, "right")) - 1
        cut = scheme(edges[band], edges[band + 1] - 1, num, 100, [100, 1e4, 1e7, 1e9][t % 4], 1e-4)
        assert large <= cut.reach and np.searchsorted(edges, large, "right") - 1 <= band + 1
        assert len(np.intersect1d(signatures(a, cut, band), signatures(b, cut, band))) >= cut.common + cut.frequent
    assert tried > 500


def test_costs_choose_deletions_for_large_bands():
    cheap, dear = (scheme(12, 17, 90, 100, sets, 1e-4) for sets in (1e3, 1e9))
    assert cheap.double == 0 and dear.double > 0


@pytest.mark.parametrize("n", [10, 60])
@pytest.mark.parametrize("left", [0, 4])
def test_linked_against_brute_force(n, left):
    rng = np.random.default_rng(n)
    sets = [np.unique(rng.integers(0, 60, int(rng.integers(5, 60))).astype(np.uint64)) for _ in range(n)]
    up = list(range(n))

    def root(i):
        return i if up[i] == i else root(up[i])

    for i in range(n):
        for j in range(i + 1, n):
            inter = len(np.intersect1d(sets[i], sets[j]))
            if (not left or i < left <= j) and 100 * inter >= 50 * (len(sets[i]) + len(sets[j]) - inter):
                up[max(root(i), root(j))] = min(root(i), root(j))
    forest = jaccard.Forest(n)
    for i, j in linked(sets, left, 50, 100):
        assert forest.join(i, j)
    assert [forest.root(i) for i in range(n)] == [root(i) for i in range(n)]


def _corpus():
    rows = []
    for g in range(12):
        base = prose(g, 30 + 25 * g)
        for c in range(1 + 4 * (g % 4)):
            rows.append((100 * g + c, edited(base, 100 * g + c, c % 6), "en", "s", 0))
    passage = prose(99, 60)
    rows += [(5000 + i, passage + " " + prose(5000 + i, 80), "en", "s", 0) for i in range(40)]
    rows += [(6000 + i, edited(prose(7, 140), 6000 + i, i % 9), "en", "s", 0) for i in range(60)]
    return rows


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
@pytest.mark.parametrize("small", [False, True])
def test_components_against_brute_force(spark, monkeypatch, k, num, small):
    if small:  # frequent signatures and blocks of families at a small size
        monkeypatch.setattr(jaccard, "BUCKET", 4)
        monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    rows = _corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(table(spark, rows), k, num, 100).collect()}
    root = brute_components([(r[0], r[1]) for r in rows], k, num, 100)
    assert got == {r[0]: (len(shingles(r[1], k)), root[r[0]]) for r in rows}
    assert 20 < len(set(root.values())) < len(rows) - 20


def test_awkward_rows(spark):
    rows = awkward_rows()
    got = ngram_components(table(spark, rows, clashes=True), 3, 90, 100).collect()
    assert len(got) == len(rows)
    # rows with one identifier are one document: the links of each count
    want = {}
    ids = sorted({r[0] for r in rows if r[0] is not None})
    root = {i: i for i in ids}
    pairs = [(r[0], shingles(r[1], 3)) for r in rows if r[0] is not None]
    for _ in ids:
        for i, a in pairs:
            for j, b in pairs:
                if a and b and 100 * len(a & b) >= 90 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    want = {i: root[i] for i in ids if i != 15}
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] not in (None, 15)} == want
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None}
    assert sorted(r["n_shingles"] for r in got if r["doc_id"] in (3, 4, 5)) == [0, 0, 0]
    assert ngram_components(table(spark, rows).limit(0)).count() == 0


def test_one_of_each_component_stays(spark):
    rows = table(spark, _corpus(), clashes=True)
    kept = without_near_copies(rows)
    assert kept.columns == rows.columns
    root = brute_components([(r[0], r[1]) for r in _corpus()], 5, 80, 100)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root.values()))
