import hashlib
from collections import defaultdict

import pytest
from llm_cases import WORD, awkward_rows, prose, table
from pyspark.sql import functions as F

from ledgerflow.llm import mixing
from ledgerflow.llm.mixing import leaf_budgets, mix_sources, source_domain


def _domain(source):
    import re
    m = re.search(r"\d+", source or "")
    return ["web", "books", "code"][int(m[0][-9:]) % 3] if m else "web"


def _water(budget, children):
    """{name: share} of {name: (weight, capacity)} by filling level by level."""
    share, open_, left = {n: 0.0 for n in children}, {n for n, (w, c) in children.items() if w > 0}, budget
    while open_ and left > 1e-9:
        level = left / sum(children[n][0] for n in open_)
        full = {n for n in open_ if children[n][1] - share[n] <= children[n][0] * level}
        for n in full or open_:
            add = children[n][1] - share[n] if full else children[n][0] * level
            share[n] += add
            left -= add
        open_ -= full
        if not full:
            break
    return share


def _budgets(supply, weights, budget, epochs):
    """supply: {(domain, lang, source): tokens}."""
    weight = lambda leaf: min((weights.get(x) or {}).get(n, 0 if weights.get(x) else 1)
                              for x, n in zip(("domain", "lang", "source"), leaf))
    usable = {leaf: n if weight(leaf) > 0 else 0 for leaf, n in supply.items()}
    out = {(): float(budget)}
    for depth, level in enumerate(("domain", "lang", "source")):
        nxt = {}
        for path, b in out.items():
            kids = defaultdict(int)
            for leaf, n in usable.items():
                if leaf[:depth] == path:
                    kids[leaf[depth]] += n * epochs
            w = weights.get(level, {})
            for name, s in _water(b, {k: (w.get(k, 0) if w else 1, c) for k, c in kids.items()}).items():
                nxt[*path, name] = s
        out = nxt
    return out


def _mix(rows, weights, share, epochs, seed):
    leaf = {}
    supply = defaultdict(int)
    n = lambda t: len(WORD.findall(t or ""))
    for i, t, lang, source, _ in rows:
        key = (_domain(source), lang or "", source or "")
        supply[key] += n(t)
    budget = int(sum(supply.values()) * share)
    spend = {k: int(v + 1e-6) for k, v in _budgets(supply, weights, budget, epochs).items()}
    out = []
    for key, tokens in spend.items():
        whole, rest = (tokens // supply[key], tokens % supply[key]) if supply[key] else (0, 0)
        mine = [r for r in rows if (_domain(r[3]), r[2] or "", r[3] or "") == key]
        order = lambda r: (int(hashlib.md5(f"{seed}:{whole}:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:15], 16),
                           -1 if r[0] is None else r[0], n(r[1]))
        for r in mine:
            upto = sum(n(x[1]) for x in mine if order(x) <= order(r))
            out.append((r[0], n(r[1]), whole + (1 if rest and upto <= rest else 0)))
    return sorted(out, key=str), budget


WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.9, 1), (1.7, 3)])
def test_against_brute_force(spark, monkeypatch, share, epochs):
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", 20_000 if epochs == 1 else 0)
    rows = awkward_rows() + [(100 + i, prose(i, i % 37), ["en", "de", "fr", "es", "xx"][i * i % 5], f"src{i % 4 if i % 3 else 0}", 0)
                             for i in range(400)]
    mixed = mix_sources(table(spark, rows, clashes=True), WEIGHTS, source_domain(F.col("source")), share, epochs, seed=3)
    got = sorted(((r["r"]["doc_id"], r["n_tokens"], r["copies"]) for r in mixed.collect()), key=str)
    want, budget = _mix(rows, WEIGHTS, share, epochs, 3)
    assert got == want
    assert sum(n * c for _, n, c in got) <= budget and max(c for *_, c in got) <= epochs


def test_null_identifiers_of_a_leaf(spark):
    """They share one key of the epoch: the order is by length, equal lengths go together."""
    rows = [(None if i % 4 else i, prose(i, 1 + i % 6), "en", "src0", 0) for i in range(500)]
    for share in (0.35, 0.7):
        mixed = mix_sources(table(spark, rows), {}, source_domain(F.col("source")), share, 1, seed=2)
        got = sorted(((r["r"]["doc_id"], r["n_tokens"], r["copies"]) for r in mixed.collect()), key=str)
        assert got == _mix(rows, {}, share, 1, 2)[0]


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "s", 10), ("a", "y", "s", 1000), ("b", "x", "s", 1000)],
                                   "__domain string, __lang string, __source string, supply long")
    w = {"domain": {"a": 1, "b": 1}, "lang": {"x": 1, "y": 1}}
    got = {(r["__domain"], r["__lang"]): r["tokens"] for r in leaf_budgets(leaves, w, F.lit(600), 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 290, ("b", "x"): 300}
    got = {(r["__domain"], r["__lang"]): r["tokens"] for r in leaf_budgets(leaves.where("__lang = 'x'"), w, F.lit(600), 1).collect()}
    assert got == {("a", "x"): 10, ("b", "x"): 590}


def test_weightless_subtrees_pass_their_share_up(spark):
    leaves = spark.createDataFrame([("a", "x", "s", 100), ("a", "zz", "s", 1000), ("b", "x", "s", 1000)],
                                   "__domain string, __lang string, __source string, supply long")
    w = {"domain": {"a": 1, "b": 1}, "lang": {"x": 1}}
    got = {(r["__domain"], r["__lang"]): r["tokens"] for r in leaf_budgets(leaves, w, F.lit(600), 1).collect()}
    assert got == {("a", "x"): 100, ("a", "zz"): 0, ("b", "x"): 500}


def test_all_or_nothing(spark):
    rows = table(spark, awkward_rows())
    mixed = mix_sources(rows, {}, source_domain(F.col("source")), share=1.0)
    assert mixed.where("copies = 0 and n_tokens > 0").count() == 0
    assert mix_sources(rows, {}, source_domain(F.col("source")), share=0.0).where("copies > 0").count() == 0
    assert mix_sources(rows.limit(0), WEIGHTS, source_domain(F.col("source"))).count() == 0


def test_plan_is_native(spark):
    mixed = mix_sources(table(spark, awkward_rows()), WEIGHTS, source_domain(F.col("source")))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in plan and "MapInArrow" not in plan and "BatchEvalPython" not in plan
