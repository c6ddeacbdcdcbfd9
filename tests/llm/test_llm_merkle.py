import random
import zlib
from hashlib import sha256

import pytest
from llm_cases import awkward_rows, prose, table

from ledgerflow.llm import merkle
from ledgerflow.llm.queries import QUERIES


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_leaf(doc_id, text, lang, source, n_chars):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def brute_tree(digests):
    """Root and, per leaf, steps (left, right)."""
    proofs, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // 8 * 8:place // 8 * 8 + 8]
            proofs[i].append(("".join(run[:place % 8]), "".join(run[place % 8 + 1:])))
            at[i] = place // 8
        level = [h(*level[i:i + 8]) for i in range(0, len(level), 8)]
    return level[0], proofs


def brute(rows):
    """The query's rows, of rows (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, brute_leaf(*r)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        members = sorted(groups[g], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[g] = members, *brute_tree([leaf for _, leaf in members])
    root, above = brute_tree([trees[g][1] for g in names])
    out = []
    for g, up in zip(names, above):
        members, subroot, proofs = trees[g]
        for (r, leaf), proof in zip(members, proofs):
            steps = proof + up
            doc_id, text = r[0], r[1]
            digest = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                digest = brute_leaf(doc_id, text.encode().lower().decode(), *r[2:])
            for left, right in steps:
                digest = h(left, digest, right)
            out.append((doc_id, leaf, subroot, root, h(*[x for s in steps for x in s]), digest, digest == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in df.collect()], key=str)


def run(spark, scratch, rows, clashes=False):
    table(spark, rows, clashes).write.parquet(f"{scratch}/documents.parquet")
    return QUERIES["op12_merkle_manifest"](spark, scratch)


def test_awkward_rows(spark, scratch):
    rows = awkward_rows()
    assert rows_of(run(spark, scratch, rows, clashes=True)) == brute(rows)


@pytest.mark.parametrize("sizes", [[1], [8, 9], [7, 64, 65, 1, 520], [3] * 11, [4097]])
def test_sizes_around_runs_and_blocks(spark, scratch, sizes):
    rng = random.Random(len(sizes))
    ids = iter(rng.sample(range(10 ** 6), sum(sizes)))
    rows = [(next(ids), f"Text {i}", None if g == 1 else f"l{g:02d}é"[:g % 5 + 2], "s", i) for g, n in enumerate(sizes) for i in range(n)]
    assert rows_of(run(spark, scratch, rows)) == brute(rows)


def test_small_blocks_take_more_rounds(spark, scratch, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(merkle, "_BLOCK", 8)
    rows = [(i, f"T{i}", "en" if i % 7 else "de", "s", 1) for i in range(700)]
    assert rows_of(run(spark, scratch, rows)) == brute(rows)


def test_equal_identifiers_and_rows(spark, scratch):
    rows = [(i // 40, f"t{i % 10}", "en", "s", 1) for i in range(400)] + [(None, f"T{i % 3}", None, None, None) for i in range(30)]
    assert rows_of(run(spark, scratch, rows)) == brute(rows)


def test_no_rows(spark, scratch):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    assert QUERIES["op12_merkle_manifest"](spark, scratch).count() == 0


def test_a_very_long_text(spark, scratch):
    rows = [(1, "Aé" * 5_000_000, "en", "s", 1), (2, "b", "en", "s", 1), (3, "", "en", "s", 0)]
    assert rows_of(run(spark, scratch, rows)) == brute(rows)


def test_proofs_are_bound_to_their_row(spark):
    """The operator's own output: proofs verify their leaf, and no other."""
    from pyspark.sql import functions as F
    rows = table(spark, [(i, prose(i, 4), "en" if i % 3 else "fr", "s", i) for i in range(100)])
    got = merkle.manifest(rows.withColumn("h", merkle.leaf_digest(F.col("doc_id"), F.col("text"))), "lang", "doc_id", "h", keep=("text", "source"))
    assert got.columns == ["doc_id", "h", "text", "source", "proof", "subroot", "root"]
    got = got.collect()
    assert all(r["h"] == h(f"{len(str(r['doc_id']))}:{r['doc_id']}", f"{len(r['text'])}:{r['text']}") for r in got)
    for a, b in zip(got, got[1:]):
        for r, leaf in ((a, a["h"]), (a, b["h"])):
            digest = leaf
            for s in r["proof"]:
                digest = h(s["left"], digest, s["right"])
            assert (digest == r["root"]) == (leaf == r["h"])


def test_messages_come_in_label_order():
    for n in (1, 2, 8, 9, 64, 65, 511, 512):
        leaves = [h(str(i)) for i in range(n)]
        levels = merkle.levels_of(n)
        children = merkle.ascend(leaves, levels)
        root, proofs = brute_tree(leaves)
        assert children[levels + 1, 0] == [root] and list(children) == sorted(children)
        assert merkle.descend(children, levels, [("x", "y")]) == [p + [("x", "y")] for p in proofs]


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert rows_of(QUERIES["op12_merkle_manifest"](spark, "/root/testdata/sf0.001")) == brute([tuple(r) for r in docs])


