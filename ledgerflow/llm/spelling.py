"""Spelling variants: words of a corpus grouped around their frequent neighbours.

Two words are *near* if one inserted, deleted or replaced letter turns one into the
other.  One edit changes the vector of a word's letter counts by an L1 distance of two at
most: a replacement takes one letter away and adds another, a deletion takes one away.  So
near words are found by range searches in k-d trees over these vectors, one tree per word
length, for each pair of lengths (L, L) and (L, L - 1):

1. Words are counted per task and then over all documents.
2. The upper part of a length's tree is shaped by a bounded sample of words (``SAMPLE``); its
   leaves are *cells* of about ``CELL`` words.  The sample decides how work is dealt, not what
   is found.
3. Every word goes to its own cell, and as a query to all cells whose box is not further away
   than one edit.  Of two cells of one length only the one numbered higher is asked.
   Cells that hold far more words than meant are dealt over several tasks.
4. In a cell the rest of the tree is built with tight boxes, queries are pruned by them, and the letters
   of what is left are compared in order.  Where a box of equal vectors holds many words,
   only words that agree in one half are compared: one edit leaves the other half as it is.
5. A word's *form* is its near word of largest count, if that is ``ratio`` times its own at
   least; forms are followed to their ends by pointer doubling (counts grow by that factor
   a step, so chains are short).

Null texts have no words, empty ones none.  Texts and words may have any length.  A row with
a null identifier has no misspelling rule applied; repeated rows count each.  Ties between
forms go to the smallest word in code-point order.  Tables without rows give none;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Texts of more characters are searched run by run instead of as one list.
WHOLE_TEXT = 200_000
#: Words that a task counts before it passes them on.
COUNTED = 300_000
#: Words that shape the trees (on the driver), and words meant for a cell.
SAMPLE, CELL = 50_000, 4096
#: Words in a box of the lower tree, queries handled at once, letters compared at once.
BOX, QUERIES, LETTERS = 32, 8192, 8_000_000

LETTER_KINDS = 26 + 64  # a-z and the 64 characters from À
_KIND = np.zeros(256, np.int64)
_KIND[97:123] = np.arange(26)
_KIND[0xC0:] = np.arange(26, LETTER_KINDS)


def with_misspellings(run: str, crc: int, every: int) -> str:
    """The run, without one letter if ``every`` divides its number."""
    if crc % every:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, every: int = 97) -> DataFrame:
    """``word, n``: words of ``shortest`` letters and ``least`` occurrences at least.

    A word is a maximal run of letters, A-Z lower-cased.  Where ``every`` divides the crc32 of
    ``<doc_id>:<word>``, the letter at that number modulo the length is left out (a
    reproducible misspelling); 0 leaves all words alone.
    """

    def emit(total: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = defaultdict(int)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if not text.is_valid:
                    continue
                # on bytes, lower() changes A-Z only
                text = text.as_py().encode().lower().decode()
                runs = RUN.findall(text) if len(text) <= WHOLE_TEXT else (m.group() for m in RUN.finditer(text))
                seen: dict[str, int] = defaultdict(int)
                for r in runs:
                    if len(r) >= shortest:
                        seen[r] += 1
                start = zlib.crc32(f"{doc_id}:".encode())
                for r, n in seen.items():
                    if every and doc_id is not None:
                        r = with_misspellings(r, zlib.crc32(r.encode(), start), every)
                    if len(r) >= shortest:
                        total[r] += n
                if len(total) > COUNTED:
                    yield emit(total)
                    total.clear()
        if total:
            yield emit(total)

    counted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of bytes (all letters are Latin-1)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts of the rows."""
    n = len(codes)
    at = np.arange(n)[:, None] * LETTER_KINDS + _KIND[codes]
    return np.bincount(at.ravel(), minlength=n * LETTER_KINDS).reshape(n, LETTER_KINDS).astype(np.int32)


def grow(points: np.ndarray, leaf: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A k-d tree: rows (letter, cut, left, right), for leaves (-1, number, 0, 0), and the
    points of every leaf.  Up to the cut goes left; the letter is the one that halves best."""
    nodes: list[list[int]] = []
    leaves: list[np.ndarray] = []
    todo = [(np.arange(len(points)), -1, 0)]
    while todo:
        members, parent, side = todo.pop()
        if parent >= 0:
            nodes[parent][side] = len(nodes)
        best = None
        if len(members) > leaf:
            mine = points[members]
            middle = np.median(mine, axis=0).astype(np.int32)
            for cut in (middle, middle - 1):
                right = (mine > cut).sum(0)
                even = np.minimum(right, len(members) - right)
                k = int(even.argmax())
                if even[k] and (best is None or even[k] > best[0]):
                    best = int(even[k]), k, int(cut[k])
        if best is None:
            nodes.append([-1, len(leaves), 0, 0])
            leaves.append(members)
            continue
        _, k, cut = best
        nodes.append([k, cut, 0, 0])
        up = points[members, k] > cut
        todo += [(members[up], len(nodes) - 1, 3), (members[~up], len(nodes) - 1, 2)]
    return np.array(nodes, np.int32), leaves


class Tree:
    """A k-d tree with a box of letter counts for every node."""

    def __init__(self, nodes: np.ndarray, points: np.ndarray | None = None, leaves: list[np.ndarray] | None = None):
        self.nodes = nodes
        self.low = np.zeros((len(nodes), LETTER_KINDS), np.int32)
        self.high = np.full((len(nodes), LETTER_KINDS), np.iinfo(np.int32).max // 2, np.int32)
        # children come after their parents
        for i, (k, cut, left, right) in enumerate(nodes):
            if k >= 0:
                self.low[[left, right]], self.high[[left, right]] = self.low[i], self.high[i]
                self.high[left, k], self.low[right, k] = cut, cut + 1
        if points is not None:  # tight boxes
            for i in range(len(nodes) - 1, -1, -1):
                k, number, left, right = nodes[i]
                if k < 0:
                    mine = points[leaves[number]]
                    self.low[i], self.high[i] = mine.min(0), mine.max(0)
                else:
                    self.low[i] = np.minimum(self.low[left], self.low[right])
                    self.high[i] = np.maximum(self.high[left], self.high[right])

    def leaves_near(self, points: np.ndarray, added: int, taken: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, indexes of points) for every leaf whose box a point reaches with so many
        letters added and so many taken away."""
        todo = [(0, np.arange(len(points)))]
        while todo:
            i, some = todo.pop()
            mine = points[some]
            near = ((np.maximum(self.low[i] - mine, 0).sum(1) <= added) & (np.maximum(mine - self.high[i], 0).sum(1) <= taken))
            some = some[near]
            if not len(some):
                continue
            k, number, left, right = self.nodes[i]
            if k < 0:
                yield int(number), some
            else:
                todo += [(int(left), some), (int(right), some)]

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        for leaf, some in self.leaves_near(points, 0, 0):
            out[some] = leaf
        return out


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of equal length: do they differ in exactly one place?"""
    return (a != b).sum(1) == 1


def one_deleted(long: np.ndarray, short: np.ndarray) -> np.ndarray:
    """For rows of which the first have one letter more: is the second the first without one?"""
    front = np.cumprod(long[:, :-1] == short, axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    back = np.cumprod((long[:, 1:] == short)[:, ::-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    return front + back >= short.shape[1]


def _halves(queries: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of queries and words that agree in the first or in the second half; one
    edit in one half leaves the other one whole (a deletion shifts the second)."""
    size, more = words.shape[1], queries.shape[1] - words.shape[1]
    half = size // 2
    for q, w in ((queries[:, :half], words[:, :half]), (queries[:, half + more:], words[:, half:])):
        at = defaultdict(list)
        for i, row in enumerate(w):
            at[row.tobytes()].append(i)
        for i, row in enumerate(q):
            if found := at.get(row.tobytes()):
                yield np.full(len(found), i), np.array(found)


def _pairs(queries: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs that may be near, some at a time; a pair may come twice."""
    step = max(1, LETTERS // max(1, len(words) * words.shape[1]))
    if len(words) <= 4 * BOX:
        for at in range(0, len(queries), step):
            some = np.arange(at, min(at + step, len(queries)))
            yield np.repeat(some, len(words)), np.tile(np.arange(len(words)), len(some))
        return
    held, size = [], 0
    for q, w in _halves(queries, words):
        held.append((q, w))
        size += len(q)
        if size * words.shape[1] > LETTERS:
            yield tuple(map(np.concatenate, zip(*held)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def near_in_cell(words: list[str], same: list[str], longer: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(kind, query indexes, word indexes) of near pairs of a cell's words (all of one
    length) with each other ("own", both are indexes of words), with ``same`` (of that
    length) and with ``longer`` (one letter more)."""
    if not words:
        return
    codes = letters(words)
    points = vectors(codes)
    nodes, leaves = grow(points, BOX)
    tree = Tree(nodes, points, leaves)
    for kind, queries in (("own", words), ("same", same), ("longer", longer)):
        for at in range(0, len(queries), QUERIES):
            asked = letters(queries[at:at + QUERIES])
            check, reach = (one_deleted, (0, 1)) if kind == "longer" else (one_replaced, (1, 1))
            for leaf, some in tree.leaves_near(vectors(asked), *reach):
                members = leaves[leaf]
                found = []
                for q, w in _pairs(asked[some], codes[members]):
                    hit = check(asked[some[q]], codes[members[w]])
                    found.append(np.stack([some[q[hit]] + at, members[w[hit]]]))
                pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
                if kind == "own":
                    pairs = pairs[:, pairs[0] < pairs[1]]
                if pairs.size:
                    yield kind, pairs[0], pairs[1]


def shape_trees(words: DataFrame) -> dict[int, np.ndarray]:
    """The upper trees by word length, from about ``SAMPLE`` words (all, if there are fewer) chosen by their hashes."""
    share = min(1.0, SAMPLE / max(1, words.count()))
    sample = words.select("word").where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))).collect()
    by_length = defaultdict(list)
    for r in sample:
        by_length[len(r["word"])].append(r["word"])
    leaf = max(1, int(CELL * share))
    return {n: grow(vectors(letters(some)), leaf)[0] for n, some in by_length.items() if len(some) > leaf}


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    words = batch.column("word").to_pylist()
    length = np.array([len(w) for w in words])
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        for part in range(0, len(at), QUERIES):
            some = at[part:part + QUERIES]
            yield int(n), some, [words[i] for i in some]


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, an, b, bn``: every unordered pair of near words of ``word, n`` once."""
    shapes = words.sparkSession.sparkContext.broadcast(shape_trees(words))  # of a bounded sample

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = {}
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int64)
            for n, some, mine in _by_length(batch):
                if n in shapes.value:
                    trees[n] = trees.get(n) or Tree(shapes.value[n])
                    cell[some] = trees[n].leaf_of(vectors(letters(mine)))
            yield batch.append_column("cell", pa.array(cell)).append_column(
                "length", pa.array([len(w) for w in batch.column("word").to_pylist()], pa.int32()))

    home = stored(words.mapInArrow(homes, "word string, n long, cell long, length int"), "homes")
    # cells of words that the sample didn't foresee; at most a cell in some thousand words
    large = {(r["length"], r["cell"]): -(-r["n"] // (4 * CELL)) for r in home.groupBy("length", "cell").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > 4 * CELL).collect()}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = {}

        def cells(n: int, points: np.ndarray, reach: tuple[int, int]) -> Iterator[tuple[int, np.ndarray]]:
            if n not in shapes.value:
                yield 0, np.arange(len(points))
                return
            trees[n] = trees.get(n) or Tree(shapes.value[n])
            yield from trees[n].leaves_near(points, *reach)

        for batch in batches:
            at, length, cell, part, role = [], [], [], [], []

            def to(some: np.ndarray, n: int, c: int, p: int | np.ndarray, r: int) -> None:
                at.append(some)
                for column, value in ((length, n), (cell, c), (part, p), (role, r)):
                    column.append(np.broadcast_to(np.int64(value) if np.isscalar(value) else value, some.shape))

            own_cell = batch.column("cell").to_numpy(zero_copy_only=False)
            for n, some, mine in _by_length(batch):
                points = vectors(letters(mine))
                spread = np.array([zlib.crc32(w.encode("latin-1")) for w in mine], np.int64)
                for c in np.unique(own_cell[some]):
                    here = np.flatnonzero(own_cell[some] == c)
                    parts = large.get((n, int(c)), 1)
                    to(some[here], n, int(c), spread[here] % parts, 0)
                    for p in range(1, parts):  # words of one large cell ask its later parts
                        to(some[here[spread[here] % parts < p]], n, int(c), p, 1)
                for c, near in cells(n, points, (1, 1)):
                    near = near[own_cell[some[near]] < c]
                    for p in range(large.get((n, c), 1)):
                        to(some[near], n, c, p, 1)
                for c, near in cells(n - 1, points, (0, 1)):
                    for p in range(large.get((n - 1, c), 1)):
                        to(some[near], n - 1, c, p, 2)
            rows = batch.select(["word", "n"]).take(pa.array(np.concatenate(at))) if at else batch.select(["word", "n"]).slice(0, 0)
            for name, column in (("length", length), ("cell", cell), ("part", part), ("role", role)):
                rows = rows.append_column(name, pa.array(np.concatenate(column) if column else [], pa.int64()))
            yield rows

    def compare(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        groups = [np.flatnonzero(role == r) for r in range(3)]
        words_, counts = table.column("word").to_pylist(), table.column("n").to_numpy()
        lists = [[words_[i] for i in g] for g in groups]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for kind, q, w in near_in_cell(*lists):
            a.append(groups[("own", "same", "longer").index(kind)][q])
            b.append(groups[0][w])
        a, b = np.concatenate(a), np.concatenate(b)
        word = table.column("word").combine_chunks()
        return pa.table({"a": word.take(pa.array(a)), "an": counts[a], "b": word.take(pa.array(b)), "bn": counts[b]})

    asked = home.select("word", "n", "cell").mapInArrow(dealt, "word string, n long, length long, cell long, part long, role long")
    return asked.groupBy("length", "cell", "part").applyInArrow(compare, "a string, an long, b string, bn long")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words of ``word, form``, by pointer doubling; forms have no cycle."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("__w"), F.col("root").alias("__to"))
        step = stored(now.join(on, now["root"] == on["__w"], "left").select(
            "word", F.coalesce("__to", "root").alias("root"), F.col("__to").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if step.where("moved").limit(1).count() == 0:
            return now


def spelling_forms(docs: DataFrame, shortest: int = 5, least: int = 3, every: int = 97, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``docs``."""
    words = stored(word_counts(docs, shortest, least, every), "words")
    sides = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("bn").alias("near_n")),
                              F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("an").alias("near_n"))))
    near = near_pairs(words).select(sides.alias("s")).select("s.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    enough = -F.col("best.m") >= ratio * F.col("n")
    formed = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n")), "forms")
    ends = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
