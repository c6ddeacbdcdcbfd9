import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import awkward_rows, table

from ledgerflow.llm import spelling
from ledgerflow.llm.queries import QUERIES
from ledgerflow.llm.spelling import Tree, grow, letters, near_in_cell, near_pairs, one_deleted, roots, spelling_forms, vectors

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def brute_words(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            if doc_id is not None and (crc := zlib.crc32(f"{doc_id}:{run}".encode())) % 97 == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 5:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 3}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(words):
    near = {w: [] for w in words}
    ordered = sorted(words)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if abs(len(a) - len(b)) < 2 and is_near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, some in near.items():
        if some:
            best = min(some, key=lambda x: (-words[x], x))
            if words[best] >= 2 * words[w]:
                form[w] = best
    out = []
    for w, n in words.items():
        end = w
        while end in form:
            end = form[end]
        out.append((w, form.get(w), end, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r[c] for c in COLUMNS) for r in df.collect()], key=str)


def random_words(seed, n, letters_="abcdeé", sizes=(5, 9)):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters_, k=rng.randint(*sizes))): rng.choice([3, 3, 4, 7, 15, 40, 100]) for _ in range(n)}


def test_awkward_rows(spark):
    rows = awkward_rows() + [(50 + i, "Straße STRASSE strasse straß×e Ététés " * 3, None, None, 1) for i in range(200)]
    assert rows_of(spelling_forms(table(spark, rows, clashes=True))) == brute(brute_words([r[:2] for r in rows]))


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    words = brute_words([tuple(r) for r in docs])
    assert len(words) > 1000
    assert rows_of(QUERIES["op13_spelling_variants"](spark, "/root/testdata/sf0.001")) == brute(words)


@pytest.mark.parametrize("cell,parts", [(4096, 4), (20, 4), (20, 0.25)])
def test_cells_and_parts_of_cells(spark, monkeypatch, cell, parts):
    """Many cells; cells with more words than meant, which are dealt over tasks."""
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "BOX", 4)
    monkeypatch.setattr(spelling, "QUERIES", 50)
    if parts < 1:
        monkeypatch.setattr(spelling, "SAMPLE", 60)  # a coarse tree
    words = random_words(1, 900, "abcd", (5, 7))
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = near_pairs(df).collect()
    ordered = sorted(words)
    want = {(b, a) for i, a in enumerate(ordered) for b in ordered[:i] if is_near(a, b)}
    assert len(want) > 300
    found = [tuple(sorted((r["a"], r["b"]))) for r in got]
    assert len(found) == len(set(found)) and set(found) == want
    assert all(words[r["a"]] == r["an"] and words[r["b"]] == r["bn"] for r in got)


@pytest.mark.parametrize("seed", range(6))
def test_one_cell_against_all_pairs(seed, monkeypatch):
    monkeypatch.setattr(spelling, "BOX", (2, 8, 32)[seed % 3])
    monkeypatch.setattr(spelling, "LETTERS", (10, 1000)[seed % 2])
    rng = random.Random(seed)
    draw = lambda size, n: sorted({"".join(rng.choices("abc", k=size)) for _ in range(n)})
    words, same, longer = draw(7, 400), draw(7, 300), draw(8, 500)
    got = {"own": set(), "same": set(), "longer": set()}
    for kind, q, w in near_in_cell(words, same, longer):
        asked = {"own": words, "same": same, "longer": longer}[kind]
        new = {(asked[i], words[j]) for i, j in zip(q, w)}
        assert len(new) == len(q) and not new & got[kind]
        got[kind] |= new
    assert got["own"] == {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if is_near(a, b)}
    assert got["same"] == {(a, b) for a in same for b in words if is_near(a, b)}
    assert got["longer"] == {(a, b) for a in longer for b in words if is_near(a, b)}


def test_words_of_equal_letters():
    """One vector: no tree can part them, halves do."""
    rng = random.Random(9)
    words = sorted({"".join(rng.sample("abcdefgh", 8)) for _ in range(3000)})
    assert not list(near_in_cell(words, [], []))  # a replacement changes the vector
    longer = sorted({w[:i] + "a" + w[i:] for w in words[:500] for i in (0, 3, 8)})
    got = {(longer[i], words[j]) for _, q, w in near_in_cell(words, [], longer) for i, j in zip(q, w)}
    assert got == {(a, a[:i] + a[i + 1:]) for a in longer for i in range(9) if a[:i] + a[i + 1:] in set(words)}


def test_boxes_hold_their_points():
    points = vectors(letters(sorted(w for w in random_words(3, 3000) if len(w) == 7)))
    nodes, leaves = grow(points, 16)
    assert sorted(np.concatenate(leaves)) == list(range(len(points)))
    tight, loose = Tree(nodes, points, leaves), Tree(nodes)
    home = np.empty(len(points), int)
    for i, members in enumerate(leaves):
        home[members] = i
    assert (loose.leaf_of(points) == home).all() and (tight.leaf_of(points) == home).all()
    for tree in (tight, loose):
        reached = {(leaf, int(i)) for leaf, some in tree.leaves_near(points, 1, 1) for i in some}
        far = np.abs(points[:, None, :] - points[None, :, :]).sum(2)
        assert all((home[j], i) in reached for i, j in zip(*np.nonzero(far <= 2)) if far[i, j] in (0, 2))


def test_deletions():
    long, short = letters(["abcab", "aabca", "abcba"]), letters(["abab", "abca", "abcc"])
    assert one_deleted(long, short).tolist() == [True, True, False]


def test_chains_are_followed_to_their_ends(spark):
    n = 40
    rows = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(n)] + [("x", "w07")]
    got = {r["word"]: r["root"] for r in roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {w: f"w{n}" for w, _ in rows}


def test_ties_and_ratio(spark):
    text = " ".join(["tables"] * 8 + ["cables"] * 8 + ["fables"] * 4 + ["gables"] * 5 + ["stablest"] * 3)
    got = {r["word"]: tuple(r)[1:] for r in spelling_forms(table(spark, [(None, text, "en", "s", 1)])).collect()}
    assert got["fables"] == ("cables", "cables", 4, 3, 8)  # equal counts: the smaller word
    assert got["gables"] == (None, "gables", 5, 3, None)  # 8 < 2 * 5
    assert got["stablest"] == (None, "stablest", 3, 0, None)


def test_no_rows_and_long_words(spark):
    docs = table(spark, awkward_rows())
    assert spelling_forms(docs.limit(0)).count() == 0
    long = "ab" * 200_000
    rows = [(i, f"{long} {long}x {long[1:]}", "en", "s", 1) for i in range(4)]
    got = {len(r["word"]): r["n_near"] for r in spelling_forms(table(spark, rows), every=0).collect()}
    assert got == {400_000: 2, 400_001: 1, 399_999: 1}
