"""Language identification with error-correcting output codes.

Every language gets a codeword of +1/-1 bits.  One binary classifier per bit
(log-odds of hashed 3- and 4-byte n-grams, calibrated by a logistic curve)
predicts that bit from the text; decoding sums, per language, the logistic
losses of the bits against its codeword, weighted by how well each bit did on
held-back training rows, and takes the least.  A prediction is flagged
ambiguous when the runner-up's loss is close, or when more bits disagree with
the nearest codeword than the code can correct.

The classifiers are fitted on at most about ``per_language`` labelled rows of
each language (a hash of the identifier decides, so the sample does not depend
on the layout of the table); every row is predicted.

Texts that are null, empty or without a letter are ``und`` with score 0 and are
not ambiguous.  Equal losses go to the language that sorts first.  Without
labelled rows every text is ``und``; with one language every text with letters
is that language.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import slices, stored, text_bytes

BUCKETS = 1 << 16
UND = "und"
_LETTER = re.compile(r"[^\W\d_]")

#: Lower-case letters and bytes of multi-byte characters stay, the rest is one separator.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_BLANK = int.from_bytes(b"   ", "little")


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """A k x bits matrix of +1/-1: the exhaustive code up to 7 classes, else the
    random code of 10 log2(k) bits with the largest least distance out of 64."""
    if k < 2:
        return np.zeros((k, 0), np.int8)
    if k <= 7:
        columns = [[1, *(1 if c >> i & 1 else -1 for i in range(k - 1))] for c in range(2 ** (k - 1) - 1)]
        return np.array(columns, np.int8).T
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(k)))
    best, most = None, -1
    for _ in range(64):
        code = rng.choice(np.array([-1, 1], np.int8), (k, bits))
        apart = (bits - code.astype(int) @ code.T.astype(int)) // 2
        least = int(apart[np.triu_indices(k, 1)].min())
        if least > most and (abs(code.sum(0)) < k).all():
            best, most = code, least
    return best


def ngram_buckets(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the 3-gram and of the 4-gram at every byte (the last 3 bytes have none)."""
    v = _FOLD[b].astype(np.uint32)
    three = v[:-3] | v[1:-2] << np.uint32(8) | v[2:-1] << np.uint32(16)
    four = three | v[3:] << np.uint32(24)
    blank = three == _BLANK
    a = (three * np.uint32(0x9E3779B1) >> np.uint32(17)).astype(np.int64)
    c = (four * np.uint32(0x85EBCA6B) >> np.uint32(17)).astype(np.int64) + BUCKETS // 2
    a[blank] = BUCKETS
    c[blank] = BUCKETS
    return a, c


def _padded(raw: np.ndarray, offsets: np.ndarray, i: int) -> np.ndarray:
    return np.concatenate(([32], raw[offsets[i]:offsets[i + 1]], [32, 32, 32, 32])).astype(np.uint8)


@dataclass(frozen=True)
class Model:
    """Languages, codewords, n-gram weights (the last bucket is neutral), logistic scale and offset, bit weights."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def margins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean n-gram log-odds per document and bit, over whole texts."""
        n, bits = len(offsets) - 1, self.code.shape[1]
        out = np.zeros((n, bits))
        if not bits or not n:
            return out
        for s, e in slices(np.asarray(offsets), 1 << 20):
            base, lengths = int(offsets[s]), np.diff(offsets[s:e + 1])
            # documents side by side with five separators between them
            gap = 5
            b = np.full(int(lengths.sum()) + gap * (e - s + 1), 32, np.uint8)
            at = offsets[s:e] - base + gap * np.arange(1, e - s + 1)
            place = np.arange(int(lengths.sum())) + np.repeat(gap * np.arange(1, e - s + 1), lengths)
            b[place] = raw[base:int(offsets[e])]
            a, c = ngram_buckets(b)
            bounds = np.minimum(at - 1, len(a) - 1)
            total = np.add.reduceat(self.weights[a] + self.weights[c], bounds, axis=0)
            count = np.add.reduceat((a != BUCKETS).astype(np.float64), bounds)
            out[s:e] = total / np.maximum(2 * count, 1)[:, None]
        return out

    def decode(self, margins: np.ndarray):
        """Index of the nearest codeword, score, loss gap to the runner-up, disagreeing bits."""
        z = margins * self.scale + self.shift
        loss = np.zeros((len(z), len(self.languages)))
        for b in range(self.code.shape[1]):
            loss += self.trust[b] * np.logaddexp(0, -np.outer(z[:, b], self.code[:, b]))
        best = loss.argmin(1)
        like = np.exp(loss.min(1)[:, None] - loss)
        score = 1 / like.sum(1)
        gap = np.partition(loss, 1, axis=1)[:, 1] - loss.min(1) if len(self.languages) > 1 else np.full(len(z), np.inf)
        wrong = (np.sign(z) * self.code[best] < 0).sum(1)
        return best, score, gap, wrong

    @property
    def corrects(self) -> int:
        """Bits that may be wrong while the nearest codeword is still the right one."""
        k = len(self.languages)
        if k < 2:
            return 0
        apart = (self.code.shape[1] - self.code.astype(int) @ self.code.T.astype(int)) // 2
        return (int(apart[np.triu_indices(k, 1)].min()) - 1) // 2


def _ngram_counts(rows: DataFrame, languages: tuple[str, ...], tasks: int) -> np.ndarray:
    """Counts per language and bucket: one packed array per task and language comes back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                a, c = ngram_buckets(_padded(raw, offsets, i))
                total = found.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                total += np.bincount(a, minlength=BUCKETS + 1) + np.bincount(c, minlength=BUCKETS + 1)
        names = list(found)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()),
                                          pa.array([zlib.compress(found[x].tobytes(), 1) for x in names], pa.binary())],
                                         names=["lang", "counts"])

    out = np.zeros((len(languages), BUCKETS + 1), np.int64)
    for r in rows.coalesce(tasks).mapInArrow(count, "lang string, counts binary").collect():
        out[languages.index(r["lang"])] += np.frombuffer(zlib.decompress(bytes(r["counts"])), np.int64)
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and offset of a logistic curve by damped Newton steps with a small ridge."""
    w = np.array([1.0, 0.0])
    spread = x.std() or 1.0
    features = np.stack([x / spread, np.ones_like(x)], 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        grad = features.T @ (p - y) + 0.01 * w
        hess = (features * (p * (1 - p))[:, None]).T @ features + 0.01 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -3, 3)
    return float(w[0] / spread), float(w[1])


def fit(docs: DataFrame, train: Column, per_language: int = 2000, seed: int = 17, tasks: int = 8) -> Model:
    """Fit on labelled rows for which ``train`` holds: about ``per_language`` rows
    of each language at most, a fifth of which only calibrate."""
    labelled = docs.select("doc_id", "text", "lang").where(train & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(sizes))
    code = codewords(len(languages))
    bits = code.shape[1]
    if not bits:
        return Model(languages, code, np.zeros((BUCKETS + 1, 0), np.float32), *[np.zeros(0)] * 3)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")), F.lit(1 << 30))
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(int(min(1, per_language / n) * (1 << 30))))])
    # bounded, and written by as many tasks as the table has, before few tasks read it
    sample = stored(labelled.where(draw < share[F.col("lang")]), "langid-sample")
    part = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_id").cast("string")), F.lit(5))
    counts = _ngram_counts(sample.where(part != 0), languages, tasks).astype(np.float64)
    counts[:, BUCKETS] = 0
    weights = np.zeros((BUCKETS + 1, bits), np.float32)
    shares = counts / np.maximum(counts.sum(1, keepdims=True), 1)  # every language weighs the same
    for b in range(bits):
        sides = [shares[code[:, b] == s].mean(0) for s in (1, -1)]
        weights[:, b] = np.log(sides[0] + 1e-6) - np.log(sides[1] + 1e-6)
    weights[BUCKETS] = 0
    rough = Model(languages, code, weights, np.ones(bits), np.zeros(bits), np.ones(bits))

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = rough.margins(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([x.tolist() for x in m], pa.list_(pa.float64()))],
                                             names=["lang", "m"])

    held = sample.where(part == 0).coalesce(tasks).mapInArrow(margins, "lang string, m array<double>").collect()
    scale, shift, trust = np.ones(bits), np.zeros(bits), np.ones(bits)
    if held:
        m = np.array([r["m"] for r in held])
        y = code[[languages.index(r["lang"]) for r in held]]
        for b in range(bits):
            if abs(y[:, b].sum()) < len(y):
                scale[b], shift[b] = _logistic(m[:, b], (y[:, b] > 0).astype(float))
                trust[b] = max(0.02, 2 * ((np.sign(m[:, b] * scale[b] + shift[b]) == y[:, b]).mean() - 0.5))
        trust /= trust.mean()
    return Model(languages, code, weights, scale, shift, trust)


def _predict(m: Model, batch: pa.RecordBatch, least_gap: float):
    """Names, scores, ambiguity and wrong bits of a batch."""
    lettered = np.array([bool(t and _LETTER.search(t)) for t in batch.column("text").to_pylist()], bool)
    if not m.languages:
        lettered[:] = False
        best, score, gap, wrong = (np.zeros(len(lettered), int) for _ in range(4))
    else:
        best, score, gap, wrong = m.decode(m.margins(*text_bytes(batch.column("text"))))
    unsure = lettered & ((gap < least_gap) | (wrong > m.corrects)) if len(m.languages) > 1 else np.zeros(len(lettered), bool)
    names = [m.languages[i] if ok else UND for i, ok in zip(best, lettered)]
    return names, np.where(lettered, score, 0.0), unsure, np.where(lettered, wrong, 0).astype(np.int32)


def _shared(docs: DataFrame, model: Model):
    """The model's parts as a broadcast (buckets x bits numbers); a ``Model`` itself would be looked up in
    this module, which executors don't have."""
    return docs.sparkSession.sparkContext.broadcast(tuple(getattr(model, f.name) for f in fields(model)))


def accepted(docs: DataFrame, model: Model, least_gap: float = 0.7, least_score: float = 0.6) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose language is known: not ``und``, and
    not ambiguous with a score below ``least_score``."""
    shared = _shared(docs, model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            names, score, unsure, _ = _predict(model, batch, least_gap)
            known = np.array([n != UND for n in names], bool) & ~(unsure & (score < least_score))
            yield batch.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def identify(docs: DataFrame, model: Model, least_gap: float = 0.7) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous, bit_errors`` for every row of ``docs``.

    ``ambiguous``: the runner-up's loss is less than ``least_gap`` away, or
    more bits are wrong than the code corrects.
    """
    shared = _shared(docs, model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("ambiguous", pa.bool_()), ("bit_errors", pa.int32())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            names, score, unsure, wrong = _predict(model, batch, least_gap)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(score, pa.float64()),
                 pa.array(unsure, pa.bool_()), pa.array(wrong, pa.int32())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(
        predict, "doc_id long, lang_pred string, score double, ambiguous boolean, bit_errors int")
