"""Small tables with the awkward cases every operator has to take."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = {"digest": "'x'", "id": "7", "n": "1", "row": "'r'", "h": "'q'", "d": "2", "__n": "3", "ord": "4", "score": "0.5",
           "domain": "'mine'", "family": "9", "spans": "'s'", "kept": "false"}


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = "an be ci do er fa go hi in ka lo me no or pa qu re si to un ve wo".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(words))


def edited(text: str, seed: int, edits: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
    return " ".join(words)


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, other scripts."""
    base, long = prose(1, 120), prose(2, 6000)
    rows = [
        (1, base, "en", "src0"), (2, base, "de", "src1"), (2, base, "de", "src1"), (3, None, "en", "src0"), (4, "", None, None),
        (5, " \t\n", "en", "src2"), (None, prose(3, 80), "en", "src0"), (None, None, None, None), (6, long, "en", "src0"),
        (7, long + " end", "en", "src0"), (8, edited(base, 5, 2), "en", "src0"), (9, "one", "fr", "src3"), (10, "one two", "fr", "src3"),
        (11, "été äöü 東京 \U0001f600 <|endoftext|> " + base, "fr", "src3"), (12, "12 34 !! 56", "fr", "src3"),
        (13, "a b c " * 400, "en", "src9"), (14, "x" * 5000, "en", "source"), (15, "  \x0b\x0cz", "en", "src0"),
        (15, "another text under the same number", "en", "src0"), (16, base.upper(), "en", "src0"), (17, base + "\n" + base, "en", "src4"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def table(spark, rows, clashes=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.selectExpr("*", *[f"{v} AS {k}" for k, v in CLASHES.items()]) if clashes else df


def shingles(text, k) -> frozenset:
    """Reference sets: A-Z lower-cased words."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(zip(*[words[i:] for i in range(k)])) if len(words) >= k else frozenset([tuple(words)])


def brute_components(rows, k, num, den) -> dict:
    """Least identifier reachable by links, of rows (doc_id, text) with identifiers."""
    docs = [(i, shingles(t, k)) for i, t in rows if i is not None]
    up = {i: i for i, _ in docs}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, (i, a) in enumerate(docs):
        for j, b in docs[:x]:
            inter = len(a & b)
            if a and b and den * inter >= num * (len(a) + len(b) - inter):
                i2, j2 = root(i), root(j)
                up[max(i2, j2)] = min(i2, j2)
    return {i: root(i) for i, _ in docs}
