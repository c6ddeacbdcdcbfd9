import numpy as np
from llm_cases import awkward_rows, prose, table

from ledgerflow.llm import licenses
from ledgerflow.llm.licenses import NOTICES, bands_for, compile_templates, scan_licenses


def _words(text):
    import re
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _contained(text, template, k=5):
    """Largest share of the template's shingles in any stretch of the text three times its length."""
    t, w = _words(template), _words(text)
    k = min(k, len(t))
    need = {tuple(t[i:i + k]) for i in range(len(t) - k + 1)}
    have = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
    at = [i for i, s in enumerate(have) if s in need]
    return max((len({have[j] for j in at if i <= j < i + 2 * len(t)}) / len(need) for i in at), default=0.0)


def test_band_settings_guarantee():
    for s in (0.05, 0.2, 0.5, 0.9):
        for rows in (1, 2):
            b = bands_for(s, rows, 1e-4)
            assert (1 - s ** rows) ** b <= 1e-4 < (1 - s ** rows) ** max(b - 1, 0)
    for g in compile_templates(NOTICES):
        for s in g.shingles:
            need = int(np.ceil(0.8 * len(s) - 1e-9))
            assert (1 - need / (2 * g.block + len(s) - need)) ** g.bands <= 1e-4


def test_notices_at_every_place(spark):
    rows, want = [], {}
    for n, (name, text) in enumerate(NOTICES.items()):
        for at in range(0, 60, 7):
            i = 1000 * n + at
            body = prose(i, 100).split()
            rows.append((i, " ".join(body[:at]) + "\n" + text.upper() + "\n" + " ".join(body[at:]), "en", "s", 0))
            want[i] = (name, at, at + len(_words(text)))
    got = {}
    for r in scan_licenses(table(spark, rows, clashes=True)).collect():
        got.setdefault(r["doc_id"], []).append((r["license"], r["start_word"], r["end_word"]))
    for i, w in want.items():
        assert w in got.get(i, []), (i, w, got.get(i))


def test_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    found = {(r["doc_id"], r["license"]) for r in scan_licenses(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    want = {(i, name) for i, t in rows for name, x in NOTICES.items() if _contained(t, x) >= 0.8 - 1e-9}
    assert want and found == want


def test_partial_and_awkward(spark):
    mit = NOTICES["mit-permission"].split()
    rows = [(1, " ".join(mit[:60]), None, None, 0), (2, " ".join(mit[:30]), None, None, 0),
            (3, "All rights\nreserved.", None, None, 0), (4, "rights reserved all", None, None, 0)]
    got = {(r["doc_id"], r["license"]) for r in scan_licenses(table(spark, rows)).collect()}
    assert got == {(1, "mit-permission"), (3, "all-rights-reserved")}
    assert scan_licenses(table(spark, awkward_rows())).count() == 0
    assert scan_licenses(table(spark, awkward_rows()).limit(0)).count() == 0
    assert licenses.compile_templates({"empty": "..."}) == []
