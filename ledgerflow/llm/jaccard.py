"""Exact Jaccard self-join on word n-grams by universe partition.

Sets A, B with |A & B| / |A | B| >= t differ in at most
H = (|A| + |B|)(1 - t)/(1 + t) elements.  The universe of shingles is split by
a hash into segments, separately for each size band, and each segment gets a
weight: 1 (the subsets of A and B that fall into it are equal) or 2 (they
differ in one element at most, found by indexing the subset and all its
one-deletion neighbours).  If the weights add up to H + c + G + F, similar sets
share c + G + F signatures at least (pigeonhole), of which

* up to G may be of light segments (empty ones; up to one element at weight 2),
  which say little: a set leaves them out up to a total weight of G and indexes
  those beyond it, so two sets that share more than G both index the last;
* up to F may be frequent (more than ``BUCKET`` sets have them): a set leaves out
  its first F frequent signatures and is joined by a star to the others that
  have one of the rest;
* c are left otherwise, so a pair from smaller buckets counts if it is found
  c times.

Sizes, weights and G are chosen per band by least cost: index rows plus the
pairs expected to agree by chance, estimated from the band's number of sets and
from the document frequency of a hash-chosen 1/256 of all shingles.

Pairs and stars make families (connected components); a frequent signature of n
sets costs n rows.  Inside families all sets are compared exactly, large
families in pairs of blocks; only links that join something are passed on.

Documents are sets of distinct ``k``-word shingles; one with fewer words is its
whole sequence, one without words (or a null text) is an empty set and links
with nothing.  Equal sets are always linked.  Rows with a null identifier get
their set size and no component; an identifier on several rows stands for all
of them.  Tables without rows give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .textops import digest_of, mix, shingle_sets, slices, stored, text_bytes

BAND_RATIO = 1.5
SAMPLED = 256
#: Sets (and shingles) in one block of a large family.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 2_000_000
#: A signature of more sets is frequent.
BUCKET = 24
#: Cost of a pair that agrees by chance, in index rows.
PAIR_COST = 8.0


def band_edges(largest: int) -> list[int]:
    """First sizes of the bands up to ``largest``, and one more."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * BAND_RATIO)))
    return edges


@dataclass(frozen=True)
class Scheme:
    """How sets are cut when the smaller one has ``low`` to ``high`` elements."""

    low: int
    high: int
    reach: int  # the largest set that can be similar to one of ``high``
    segments: int
    double: int  # the first so many segments have weight 2
    spare: int  # G
    frequent: int  # F
    common: int  # c


def max_difference(a: int, b: int, num: int, den: int) -> int:
    """Largest symmetric difference of sets of a and b elements with similarity >= num/den."""
    return (a + b) * (den - num) // (den + num)


def _share_over(n: int, p: float, g: int) -> float:
    """E[max(X - g, 0)] / E[X] of a binomial X."""
    if p <= 0:
        return 0.0
    p = min(p, 1 - 1e-9)
    log_term, below, part = n * math.log1p(-p), 0.0, 0.0
    for i in range(min(g, n) + 1):
        term = math.exp(log_term)
        below, part = below + term, part + i * term
        if i < n:
            log_term += math.log((n - i) / (i + 1) * p) - math.log1p(-p)
    return max(0.0, n * p - part - g * max(0.0, 1 - below)) / (n * p)


def scheme(low: int, high: int, num: int, den: int, sets: float, share: float) -> Scheme:
    """The cheapest cut for a band that holds ``sets`` sets; ``share`` is the chance
    that a shingle of one set is in another one."""
    reach = high * den // num
    need = max_difference(high, reach, num, den) + 1
    # small sets have no segments to spare
    common = 2 if need >= 6 else 1
    frequent = min(8, need // 6)
    need += common - 1 + frequent
    middle = (low + high) / 2
    best = None
    for double in sorted({0, *(round(need / 2 * i / 8) for i in range(1, 9)), (need + 1) // 2}):
        for spare in sorted({0, 1, 2, 3, 4, 6, 8, 10, *(round(need * i / 24) for i in range(13))}):
            segments = double + max(0, need + spare - 2 * double)
            if segments < 1:
                continue
            q, single = middle / segments, segments - double
            none, alike = math.exp(-2 * q), 2 * q * share
            light = (single * math.exp(-q) + double * math.exp(-q) * (1 + q)) / segments
            kept = _share_over(segments, light, spare)
            rows = single * (1 - math.exp(-q)) + double * (1 + q) + kept * light * segments
            by_chance = none * ((math.exp(alike) - 1) * (single + double * (1 + 2 * q))
                                + kept * kept * (single + double * (1 + 2 * q)))
            cost = sets * rows + PAIR_COST * sets * sets / 2 * by_chance
            if best is None or cost < best[0]:
                best = (cost, Scheme(low, high, reach, segments, double, spare, frequent, common))
    return best[1]


def signatures(tokens: np.ndarray, s: Scheme, number: int) -> np.ndarray:
    """Distinct signatures of a set under scheme ``number``, which is in their last 6 bits."""
    m = s.segments
    salted = mix(tokens ^ np.uint64(0xA5A5A5A55A5A5A5A + 2 * s.low))
    segment = ((salted >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    value = mix(salted)
    low = np.bincount(segment, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), m).astype(np.uint64)
    high = np.bincount(segment, (value >> np.uint64(32)).astype(np.float64), m).astype(np.uint64)
    total = (high << np.uint64(32)) + low
    size = np.bincount(segment, minlength=m)
    index = np.arange(m)
    weight = np.where(index < s.double, 2, 1)
    salt = mix(np.uint64(s.low) * np.uint64(1 << 32) + index.astype(np.uint64))
    light = size < weight
    beyond = light & (np.cumsum(np.where(light, weight, 0)) > s.spare)
    # a single element at weight 2 is light, but its whole subset is another set's deletion
    whole = (size > 0) | beyond
    # a deletion of a single element is the empty subset: beyond G only
    inside = (segment < s.double) & ((size[segment] > 1) | beyond[segment])
    empty = beyond & (weight == 2) & (size == 0)  # weight 2 counts twice
    out = [mix(total[whole] + salt[whole]), mix(total[segment[inside]] - value[inside] + salt[segment[inside]]),
           mix(~salt[empty])]
    return np.unique(np.concatenate(out) & ~np.uint64(63) | np.uint64(number))


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    raw, offsets = text_bytes(batch.column("text"))
    for s, e in slices(offsets):
        yield from zip(range(s, e), shingle_sets(raw, offsets[s:e + 1], k))


def set_sizes(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n, digest, digest2, sample``: set size, two independent digests of
    the set, and its share of the sampled shingles."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.int64()), ("digest2", pa.int64()),
                        ("sample", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, sample = [], [], [], []
            for _, tokens in _sets(batch, k):
                n.append(len(tokens))
                a.append(digest_of(tokens))
                b.append(digest_of(tokens ^ np.uint64(0x5DEECE66D1CE4E5B)))
                sample.append(tokens[tokens % np.uint64(SAMPLED) == 0].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()),
                                              pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                              pa.array(sample, pa.list_(pa.int64()))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, digest long, digest2 long, sample array<long>")


def schemes(sizes: DataFrame, num: int, den: int) -> list[Scheme]:
    """One scheme per size band, from the counts of all sets (a handful of rows per band reaches the driver)."""
    largest = sizes.agg(F.max("n")).first()[0] or 0
    edges = band_edges(largest)
    band = F.expr(f"size(filter(array({', '.join(map(str, edges))}), e -> e <= n)) - 1")
    per_band = sizes.where("n > 0").withColumn("band", band)
    counts = {r["band"]: r["sets"] for r in per_band.groupBy("band").agg(
        F.approx_count_distinct("digest", 0.02).alias("sets")).collect()}
    often = (per_band.select("band", "digest", F.explode("sample").alias("token")).distinct()
             .groupBy("band", "token").agg(F.count(F.lit(1)).alias("f"))
             .groupBy("band").agg(F.sum(F.col("f") * (F.col("f") - 1)).alias("pairs"), F.sum("f").alias("all")))
    shares = {r["band"]: r["pairs"] / max(r["all"], 1) / max(counts.get(r["band"], 1) - 1, 1) for r in often.collect()}
    return [scheme(edges[b], edges[b + 1] - 1, num, den, counts.get(b, 0) + counts.get(b + 1, 0), min(shares.get(b, 0.0), 0.9))
            for b in range(len(edges) - 1)]


def candidate_rows(docs: DataFrame, k: int, cuts: list[Scheme]) -> DataFrame:
    """``sig, id``: a row per distinct signature of every set, under its own band and,
    where it can be similar to a set of the band below, under that one too."""
    lows = np.array([c.low for c in cuts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            sigs, ids, held = [], [], 0
            for _, tokens in _sets(batch, k):
                if not len(tokens) or (key := digest_of(tokens)) in seen:
                    continue
                seen.add(key)
                band = int(np.searchsorted(lows, len(tokens), "right")) - 1
                for b in (band - 1, band):
                    if b >= 0 and len(tokens) <= cuts[b].reach:
                        x = signatures(tokens, cuts[b], b).view(np.int64)
                        sigs.append(x)
                        ids.append(np.full(len(x), key))
                        held += len(x)
                if held > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(ids))], names=["sig", "id"])
                    sigs, ids, held = [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(ids))], names=["sig", "id"])

    return docs.select("text").mapInArrow(run, "sig long, id long")


def bucket_rows(rows: DataFrame) -> DataFrame:
    """``frequent, a, b``: the pairs of ids in every bucket of up to ``BUCKET`` sets, and
    (signature, id) of every set in a larger one.  One pass over sorted rows in
    bounded memory."""
    schema = pa.schema([("frequent", pa.bool_()), ("a", pa.int64()), ("b", pa.int64())])

    def rows_of(sig: np.ndarray, ids: np.ndarray, known: int | None) -> list[pa.RecordBatch]:
        """Of whole runs of equal signatures; ``known`` is one whose set is frequent already."""
        if not len(sig):
            return []
        start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        size = np.diff(np.append(start, len(sig)))
        each = np.repeat(size, size)
        large = each > BUCKET
        if known is not None:
            large |= sig == known
        out = [pa.RecordBatch.from_arrays([pa.array(np.ones(large.sum(), bool)), pa.array(sig[large]), pa.array(ids[large])],
                                          schema=schema)] if large.any() else []
        few = ~large & (each > 1)
        s, i = sig[few], ids[few]
        for lag in range(1, min(BUCKET, len(s))):
            same = s[lag:] == s[:-lag]
            if not same.any():
                break
            a, b = i[:-lag][same], i[lag:][same]
            # the scheme stands in the signature's last bits; it goes with the pair
            out.append(pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(a), bool)), pa.array(a), pa.array(b)], schema=schema)
                .append_column("number", pa.array((s[lag:][same] & 63).astype(np.int32))))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, ids, known = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            sig = np.concatenate((sig, batch.column("sig").to_numpy(zero_copy_only=False)))
            ids = np.concatenate((ids, batch.column("id").to_numpy(zero_copy_only=False)))
            new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1]))) if len(sig) else np.zeros(0, bool)
            sig, ids = sig[new], ids[new]
            if not len(sig):
                continue
            last = int(np.searchsorted(sig, sig[-1]))
            yield from map(numbered, rows_of(sig[:last], ids[:last], known))
            if last:
                known = None
            sig, ids = sig[last:], ids[last:]
            if len(sig) > BUCKET + 1:  # goes on, but is frequent already: all but its last row can leave
                known = int(sig[0])
                yield from map(numbered, rows_of(sig[:-1], ids[:-1], known))
                sig, ids = sig[-1:], ids[-1:]
        yield from map(numbered, rows_of(sig, ids, known))

    def numbered(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "number" in batch.schema.names:
            return batch
        return batch.append_column("number", pa.array((batch.column("a").to_numpy() & 63).astype(np.int32)))

    tasks = rows.repartition("sig").sortWithinPartitions("sig", "id")
    return tasks.mapInArrow(run, "frequent boolean, a long, b long, number int")


def families(rows: DataFrame, cuts: list[Scheme]) -> DataFrame:
    """``node, root``: components of the pairs found often enough and of the stars."""
    found = stored(bucket_rows(rows), "buckets")
    per_cut = lambda values: F.array(*[F.lit(v) for v in values])[F.col("number")]
    pairs = (found.where("not frequent").groupBy("a", "b", "number").agg(F.count(F.lit(1)).alias("times"))
             .where(F.col("times") >= per_cut([c.common for c in cuts])))
    place = F.row_number().over(Window.partitionBy("b", "number").orderBy("a"))  # one set's signatures
    stars = stored(found.where("frequent").withColumn("place", place).where(F.col("place") > per_cut([c.frequent for c in cuts]))
                   .select("a", "b"), "stars")
    # the hub of a signature is joined back on a key of its own, so that one with very many sets can be split
    hubs = stars.groupBy(F.bitwise_not("a").alias("k")).agg(F.min("b").alias("hub"))
    stars = stars.join(hubs, F.bitwise_not("a") == F.col("k")).where("hub <> b")
    return components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
                      .unionByName(stars.select(F.col("hub").alias("u"), F.col("b").alias("v"))))


class Forest:
    """Union-find over 0..n-1; the least member is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def _similar(inter: int, a: int, b: int, num: int, den: int) -> bool:
    return den * inter >= num * (a + b - inter)


def linked(sets: list[np.ndarray], left: int, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``.  With 0 < left < len(sets) only pairs
    across that border are compared, else all."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    forest, out = Forest(n), []
    across = 0 < left < n
    if n <= 24:
        for j in range(1, n):
            for i in range(j):
                if across and not i < left <= j or forest.root(i) == forest.root(j):
                    continue
                a, b = int(sizes[i]), int(sizes[j])
                if den * min(a, b) >= num * max(a, b) and _similar(
                        len(np.intersect1d(sets[i], sets[j], assume_unique=True)), a, b, num, den) and forest.join(i, j):
                    out.append((i, j))
        return out
    # shingles that occur in one set only are in no intersection
    _, inverse, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.where(often > 1, np.cumsum(often > 1) - 1, -1)[inverse]
    row = np.repeat(np.arange(n), sizes)
    keep = number >= 0
    row, number = row[keep], number[keep]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    rows_of = (np.arange(left), np.arange(left, n)) if across else (np.arange(n), np.arange(n))
    inter = np.zeros((len(rows_of[0]), len(rows_of[1])), np.float32)
    step = max(256, (16 << 20) // (4 * n))
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, step):
        lo, hi = np.searchsorted(number, (at, at + step))
        dense = np.zeros((n, step), np.float32)
        dense[row[lo:hi], number[lo:hi] - at] = 1
        inter += dense[rows_of[0]] @ dense[rows_of[1]].T
    total = sizes[rows_of[0]][:, None] + sizes[rows_of[1]][None, :]
    hit = (num + den) * inter.astype(np.int64) >= num * total
    for i, j in zip(*np.nonzero(hit)):
        i, j = int(rows_of[0][i]), int(rows_of[1][j])
        if i != j and forest.join(i, j):
            out.append((i, j))
    return out


def verified_links(docs: DataFrame, members: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``u, v, whole``: links among the members (``id, digest, n, family``) of each family
    that are enough to connect what is linked.  ``whole``: the family was compared in one piece."""
    size = members.groupBy("family").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    size = stored(size.where("sets > 1").withColumn("blocks", blocks), "families")
    small = size.where("blocks = 1").agg(F.sum("sets"), F.sum("shingles")).first()
    buckets = int(max(1, (small[0] or 0) // 1000, (small[1] or 0) // BLOCK_SHINGLES))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = (members.join(size, "family").withColumn("block", block)
              # a block meets every block of its family once; one with all others is in as many groups
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("id", "digest", "family", "block", (F.col("blocks") == 1).alias("whole"),
                      F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(buckets))).otherwise(F.col("family")).alias("bucket"),
                      F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    rows = placed.groupBy("id", "digest", "family", "block").agg(F.collect_list(F.struct("whole", "bucket", "i", "j")).alias("groups"))
    rows = rows.join(texts, "id").withColumn("g", F.explode("groups")).select(
        "id", "digest", "family", "block", "text", "g.whole", "g.bucket", "g.i", "g.j")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("family", "ascending"), ("block", "ascending"), ("id", "ascending")])
        sets = [t for b in table.combine_chunks().to_batches() for _, t in _sets(b, k)]
        ids, family = table.column("id").to_pylist(), table.column("family").to_pylist()
        digest, block = table.column("digest").to_pylist(), table.column("block").to_pylist()
        whole = table.column("whole")[0].as_py()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        u, v = [], []
        at = 0
        while at < len(ids):
            end = at
            while end < len(ids) and family[end] == family[at]:
                end += 1
            # an identifier may stand on rows with other texts: only the row meant counts
            own = [x for x in range(at, end) if digest_of(sets[x]) == digest[x]]
            left = sum(block[x] == i for x in own) if i != j else 0
            for a, b in linked([sets[x] for x in own], left, num, den):
                u.append(ids[own[a]])
                v.append(ids[own[b]])
            at = end
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "whole": pa.array([whole] * len(u), pa.bool_())})

    return rows.groupBy("whole", "bucket", "i", "j").applyInArrow(compare, "u long, v long, whole boolean")


def ngram_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: documents whose sets have a
    similarity of num/den at least are linked, a component is named by its least ``doc_id``."""
    sizes = stored(set_sizes(docs, k), "sets")
    cuts = schemes(sizes, num, den)
    same = ["digest", "digest2", "n"]
    reps = sizes.where("n > 0 and doc_id is not null").groupBy(same).agg(F.min("doc_id").alias("id"))
    groups = families(candidate_rows(docs, k, cuts), cuts) if cuts else None
    if groups is not None:
        members = stored(reps.join(groups, reps["digest"] == groups["node"]).select(
            "id", "digest", "n", F.col("root").alias("family")), "members")
        links = stored(verified_links(docs, members, k, num, den), "links")
        # also what a family compared in one piece yields is a forest, not a star
        named = components(links.select("u", "v"))
        reps = reps.join(named, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("root", "id"))
    else:
        reps = reps.withColumn("component", F.col("id"))
    return sizes.join(reps.select(*same, "component"), same, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def without_near_copies(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with the document of the least identifier of each component, all columns
    unchanged; rows with a null identifier stay."""
    others = ngram_components(docs, k, num, den).where("doc_id <> component_id").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct("*").alias("r"), F.col("doc_id").cast("long").alias("d"))
    return rows.join(others, F.col("d") == F.col("id"), "left_anti").select("r.*")
