"""The operators' results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Mapping

#: Words of a text: runs outside \x20 and \x09-\x0D.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) END AS g FROM w),
-- equal sets are one node
k AS (SELECT doc_id, len(g) AS n, md5(array_to_string(list_sort(g), chr(10))) AS h, g FROM s),
node AS (SELECT h, min(doc_id) AS id, any_value(n) AS n, any_value(g) AS g FROM k WHERE n > 0 GROUP BY h),
token AS (SELECT id, n, unnest(g) AS t FROM node),
pair AS (SELECT a.id AS a, b.id AS b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb FROM token a JOIN token b USING (t)
         WHERE a.id < b.id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY a.id, b.id),
link AS (SELECT a, b FROM pair WHERE 100 * common >= 90 * (na + nb - common)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT id AS a, id AS b FROM node UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
comp AS (SELECT a AS id, min(b) AS c FROM reach GROUP BY a)
SELECT k.doc_id, k.n AS n_shingles, coalesce(c.c, k.doc_id) AS component_id FROM k LEFT JOIN node ON node.h = k.h AND k.n > 0 LEFT JOIN comp c ON c.id = node.id
"""

REVISITS = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages)
SELECT page_id, octet_length(encode(body)) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
        (('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
    if(page_id = max(page_id) OVER same, 'response', 'revisit') AS record_type,
    if(page_id = max(page_id) OVER same, NULL, max(page_id) OVER same) AS refers_to
FROM p WINDOW same AS (PARTITION BY body)
"""

REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
places AS (SELECT doc_id, unnest(range(n - 49)) AS s, x FROM d WHERE n >= 50),
str AS (SELECT doc_id, s, md5(substr(x, 2 * s + 1, 100)) AS v FROM places),
first AS (SELECT v, min(doc_id) AS owner FROM str GROUP BY v HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, s FROM str JOIN first USING (v) WHERE owner < doc_id),
-- runs of removed bytes: a start more than 50 after the one before begins a new one
step AS (SELECT doc_id, s, (s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > 50)::INT AS fresh FROM gone),
run AS (SELECT doc_id, s, sum(coalesce(fresh, 0)) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM step),
span AS (SELECT doc_id, r, min(s) AS b, max(s) + 50 AS e FROM run GROUP BY doc_id, r),
cut AS (SELECT doc_id, list(b ORDER BY b) AS b, list(e ORDER BY b) AS e, sum(e - b)::BIGINT AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
    sha256(unhex(CASE WHEN spans IS NULL THEN x ELSE array_to_string(list_transform(range(len(b) + 1), lambda i:
        substr(x, CASE WHEN i = 0 THEN 1 ELSE 2 * e[i] + 1 END, CASE WHEN i < len(b) THEN 2 * b[i + 1] ELSE 2 * n END
               - CASE WHEN i = 0 THEN 0 ELSE 2 * e[i] END)), '') END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

#: The rules' values in SQL, by name.
_VALUES = {
    "symbols": "n_symbols / greatest(n_words, 1)", "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)", "long_words": "word_chars / greatest(n_words, 1)",
    "short_words": "-(word_chars / greatest(n_words, 1))",
}

MEASURES = r"""
w AS (SELECT doc_id, lang, coalesce(text, '') AS t, @WORDS@ AS w FROM documents),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
                   unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w),
often AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM often, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (SELECT l.doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(c.n, 0) AS n_repeat_words FROM l LEFT JOIN covered c USING (doc_id)),
measured AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)""".replace("@WORDS@", WORDS)


def quality_sql(cutoffs: Mapping[str, list[float]], alpha: float = 0.02, delta: float = 0.05, price: float = 20.0) -> str:
    """Measures, calibration and verdict; ``cutoffs`` by rule, from lenient to strict."""
    names = list(cutoffs)
    passes = ", ".join(f"len(list_filter({list(cutoffs[r])}, lambda c: c > {_VALUES[r]})) AS p_{r}" for r in names)
    level = f"{delta} / (greatest((SELECT count(DISTINCT coalesce('=' || stratum, 'null')) FROM held), 1) * {len(names)})"
    p = alpha / len(names)
    parts = [f"""
label AS (SELECT doc_id, max(quality) >= 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT lang AS stratum, good, {passes} FROM measured JOIN label USING (doc_id) WHERE NOT base_failed)"""]
    for k, r in enumerate(names):
        caught = " OR ".join(f"coalesce(p_{x} <= c_{x}.step, false)" for x in names[:k]) or "false"
        earlier = " ".join(f"LEFT JOIN cut_{x} c_{x} ON c_{x}.stratum IS NOT DISTINCT FROM h.stratum" for x in names[:k])
        parts.append(f"""
seen_{r} AS (SELECT h.stratum, good, p_{r} AS p, ({caught}) AS caught FROM held h {earlier}),
step_{r} AS (SELECT s.stratum, g.step, count(*) FILTER (good) AS n, count(*) FILTER (good AND p <= step) AS lost,
    count(*) FILTER (NOT good AND p <= step AND NOT caught) - {price} * count(*) FILTER (good AND p <= step AND NOT caught) AS gain
    FROM seen_{r} s, (SELECT unnest(range({len(cutoffs[r])})) AS step) g GROUP BY s.stratum, g.step),
tail_{r} AS (SELECT *, list_sum(list_transform(range(lost + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
    + i * ln({p}) + (n - i) * ln(1 - {p})))) > {level} AS bad FROM step_{r}),
pass_{r} AS (SELECT *, max(bad::INT) OVER (PARTITION BY stratum ORDER BY step) AS failed FROM tail_{r}),
cut_{r} AS (SELECT stratum, arg_max(step, gain * 1000 - step) AS step FROM pass_{r} WHERE failed = 0 AND gain > 0 GROUP BY stratum)""")
    fails = ", ".join(f"CASE WHEN {_VALUES[r]} >= {list(cutoffs[r])}[c_{r}.step + 1] THEN '{r}' END" for r in names)
    joins = " ".join(f"LEFT JOIN cut_{r} c_{r} ON c_{r}.stratum IS NOT DISTINCT FROM m.lang" for r in names)
    return f"""
WITH {MEASURES},{','.join(parts)},
judged AS (SELECT m.*, concat_ws(',', {fails}) AS failed_rules FROM measured m {joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
"""

#: The table of CRC-32 as a list, for the unsigned CRC-32 of a string's UTF-8 bytes.
CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


def crc32_sql(text: str) -> str:
    return f"""xor(list_reduce([4294967295::BIGINT] || list_transform(range(octet_length(encode({text}))),
        lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


def _field_sql(name: str) -> str:
    text = f"({name})::VARCHAR"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _run_sql(part: str) -> str:
    """Siblings left and right of a node in its run of eight."""
    window = f"OVER (PARTITION BY {part}lv, i // 8 ORDER BY i ROWS BETWEEN"
    return (f"coalesce(string_agg(d, '') {window} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(d, '') {window} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r")


MERKLE = f"""
WITH RECURSIVE {CRC_TABLE},
lower_ AS (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents),
hashed AS (SELECT doc_id, lang, {_leaf_sql('text')} AS leaf,
                  CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN {_leaf_sql('lowered')} END AS changed FROM lower_, crc_table),
leafs AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
node AS (SELECT lang, 0 AS lv, i, n, leaf AS d FROM leafs UNION ALL
         SELECT lang, lv + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY lang, lv, i // 8),
sub AS (SELECT lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
up AS (SELECT 0 AS lv, i, n, d FROM sub UNION ALL
       SELECT lv + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY lv, i // 8),
step AS (SELECT lang, lv, i, {_run_sql('lang, ')} FROM node WHERE n > 1),
up_step AS (SELECT lv, i, {_run_sql('')} FROM up WHERE n > 1),
walk AS (SELECT doc_id, lang, leaf, coalesce(changed, leaf) AS cur, '' AS proof, 0 AS lv, i, n FROM leafs UNION ALL
         SELECT doc_id, w.lang, leaf, sha256(l || cur || r), proof || l || r, w.lv + 1, w.i // 8, (n + 7) // 8
         FROM walk w JOIN step s ON s.lang IS NOT DISTINCT FROM w.lang AND s.lv = w.lv AND s.i = w.i),
last_ AS (SELECT doc_id, leaf, sub.d AS subroot, cur, proof, 0 AS lv, sub.i, sub.n FROM walk w JOIN sub ON sub.lang IS NOT DISTINCT FROM w.lang WHERE w.n = 1
          UNION ALL SELECT doc_id, leaf, subroot, sha256(l || cur || r), proof || l || r, w.lv + 1, w.i // 8, (n + 7) // 8
          FROM last_ w JOIN up_step s ON s.lv = w.lv AND s.i = w.i)
SELECT doc_id, leaf, subroot, up.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = up.d AS verified
FROM last_, up WHERE last_.n = 1 AND up.n = 1
"""

SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE},
run AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents),
each AS (SELECT doc_id, r, count(*) AS c FROM run WHERE length(r) >= 5 GROUP BY doc_id, r),
numbered AS (SELECT *, {crc32_sql("(doc_id || ':' || r)")} AS h FROM each, crc_table),
read_ AS (SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word, c FROM numbered),
word AS (SELECT word, sum(c)::BIGINT AS n FROM read_ WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM word)),
-- replaced in place i, or one without a letter that the other has
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM cut a JOIN word b ON a.rest = b.word
         UNION SELECT b.word, a.word, a.n FROM cut a JOIN word b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS top, arg_min(near, (-near_n, near)) AS near FROM near GROUP BY word),
form AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * n THEN near END AS form, CASE WHEN top >= 2 * n THEN top END AS form_n
         FROM word w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS tip, 0 AS k FROM form UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN form f ON f.word = c.tip WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM form f JOIN (SELECT word, arg_max(tip, k) AS root FROM chain GROUP BY word) r USING (word)
"""
