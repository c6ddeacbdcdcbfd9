"""Byte-level BPE by prefix dynamic programming, and back.

A text is cut into pieces by the tokenizer's pattern.  For every byte prefix of
a piece the *last token* of its encoding is stored.  It is unique: of the tokens
that end where the prefix ends it is the one that stays apart from the last token
of the prefix before it, that is, merging their bytes alone by rank gives exactly
these two.  The encoding is read off backwards.  As an entry only depends on
entries before it, bytes can be appended exactly, and after an edit entries are
computed from the first changed byte until as many entries as the longest token
has bytes agree with the old ones.

A piece that is a token as a whole is that token, as in the ``tiktoken`` library,
also when no merges lead to it.

Null and empty texts have no ids and decode to no bytes.  Texts and pieces of any
length take time in proportion to their bytes.  Rows are encoded one by one:
repeated identifiers and null ones stay as they are, a table without rows gives
none, other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import itertools
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that the pattern may look at beyond a piece's end, plus one: a longer
#: white-space run leaves its last character to the next piece.
LOOKAHEAD = 2
#: Pieces that a worker remembers before the older half may go, and their longest (characters).
REMEMBERED, LONGEST_REMEMBERED = 300_000, 64
#: Texts of more characters are cut piece by piece instead of as one list.
WHOLE_TEXT = 200_000
#: Pieces of more bytes keep their prefix table for later edits.
LONG_PIECE = 256
#: Ids in one Arrow batch of results (more if one text has more).
IDS_PER_BATCH = 1_000_000

_NEVER = 1 << 60


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks without gaps are needed")
    return tokens


def merge_by_rank(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The definition: the adjacent parts of least rank are joined, the leftmost first, until none has a rank."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(itertools.pairwise(parts)))
        if rank == _NEVER:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def last_merges(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per token the two tokens that its last merge joins; -1 for single bytes, -2 for a
    token that its own bytes don't merge to."""
    ranks = {t: i for i, t in enumerate(tokens)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a token for every byte is needed")
    left, right = np.full(len(tokens), -2, np.int32), np.full(len(tokens), -2, np.int32)
    for i, token in enumerate(tokens):
        if len(token) == 1:
            left[i] = right[i] = -1
            continue
        # without the token's own rank its merges stop at the last two parts
        parts = merge_by_rank(token, _Without(ranks, token))
        if len(parts) == 2:
            left[i], right[i] = ranks[parts[0]], ranks[parts[1]]
            if max(left[i], right[i]) >= i:
                raise ValueError(f"token {i} ranks below a part of its own")
    return left, right


class _Without(dict):
    """``ranks`` without one token (nothing is copied)."""

    def __init__(self, ranks: dict, token: bytes):
        super().__init__()
        self.ranks, self.token = ranks, token

    def get(self, key, default=None):
        return default if key == self.token else self.ranks.get(key, default)


class Encoder:
    """Tokens, what may follow what, and the pieces seen last."""

    def __init__(self, tokens: list[bytes], left: np.ndarray, right: np.ndarray, pattern: str):
        import ahocorasick
        import regex

        self.tokens, self.ranks = tokens, {t: i for i, t in enumerate(tokens)}
        self.left, self.right = left.tolist(), right.tolist()
        self.longest = max(map(len, tokens))
        self.pattern = regex.compile(pattern)
        self.ending = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            if left[i] != -2:
                self.ending.add_word(t.decode("latin-1"), i)
        self.ending.make_automaton()
        self.sizes = list(map(len, tokens))
        self.apart: list[dict[int, bool]] = [{} for _ in tokens]  # by the second token
        self.pairs = 0
        self.known = _Known(self)

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether the bytes of tokens a and b merge to exactly a, b.

        Only a merge across the border can prevent it.  The parts that touch the border
        grow from single bytes to a and b by their own merges, in the order of ranks; a
        join across comes first if it ranks below both next merges (or equal to the
        right one: the leftmost goes first).
        """
        found = self.apart[b].get(a)
        if found is None:
            self.pairs += 1
            if self.pairs > 2_000_000:
                self.pairs = 0
                for known in self.apart:
                    known.clear()
            found = self.apart[b][a] = self._stay_apart(a, b)
        return found

    def _stay_apart(self, a: int, b: int) -> bool:
        touching_a, touching_b = [a], [b]
        while (r := self.right[touching_a[-1]]) >= 0:
            touching_a.append(r)
        while (r := self.left[touching_b[-1]]) >= 0:
            touching_b.append(r)
        i, j = len(touching_a) - 1, len(touching_b) - 1
        while True:
            next_a = touching_a[i - 1] if i else _NEVER
            next_b = touching_b[j - 1] if j else _NEVER
            across = self.ranks.get(self.tokens[touching_a[i]] + self.tokens[touching_b[j]], _NEVER)
            if across < next_a and across <= next_b and across < _NEVER:
                return False
            if next_a == next_b == _NEVER:
                return True
            if next_a <= next_b:
                i -= 1
            if next_b <= next_a:
                j -= 1

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.read_back(self.last_tokens(data))

    def last_tokens(self, data: bytes) -> list[int]:
        """The last token of every prefix of a piece."""
        last: list[int] = []
        size, sizes, apart, stay_apart, append = 0, self.sizes, self.apart, self.stay_apart, last.append
        for end, token in self.ending.iter(data.decode("latin-1")):
            if end < size:
                continue
            before = end - sizes[token]
            if before >= 0:
                before = last[before]
                fits = apart[token].get(before)
                if not (stay_apart(before, token) if fits is None else fits):
                    continue
            append(token)
            size += 1
        if size != len(data):
            raise ValueError("a prefix has no encoding")
        return last

    def read_back(self, last: Sequence[int]) -> list[int]:
        """The encoding of the longest prefix."""
        out, at = [], len(last) - 1
        while at >= 0:
            out.append(last[at])
            at -= self.sizes[last[at]]
        return out[::-1]

    def pieces(self, text: str) -> Iterable[str]:
        if len(text) <= WHOLE_TEXT:
            return self.pattern.findall(text)
        return (m.group() for m in self.pattern.finditer(text))

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text."""
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.pieces(text))), np.int32)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Known(dict):
    """Ids (as bytes) of the pieces met lately; long pieces are not kept."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = array("i", self.encoder.piece(piece.encode())).tobytes()
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


class Prefixes:
    """The last token of every byte prefix of one piece."""

    def __init__(self, encoder: Encoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", array("i")
        self.computed = 0
        if data:
            self.append(data)

    def append(self, more: bytes) -> None:
        """Exact: entries so far stay."""
        self.data += more
        self._solve(array("i"), len(self.data))

    def become(self, data: bytes) -> None:
        """The piece is edited into ``data``; entries near the edit are computed."""
        old, old_last = self.data, self.last
        same = min(len(old), len(data))
        start = next((i for i in range(same) if old[i] != data[i]), same)
        tail = next((i for i in range(same - start) if old[-1 - i] != data[-1 - i]), same - start)
        self.data, self.last = data, old_last[:start]
        self._solve(old_last[len(old) - tail:], len(data) - tail)

    def _solve(self, old: array, tail: int) -> None:
        """Fill in the missing entries; ``old`` are earlier entries of the bytes from ``tail`` on."""
        enc, last = self.encoder, self.last
        size = first = len(last)
        # a token that ends at a new byte starts this far before it at most
        context = max(0, first - enc.longest + 1)
        agreed, text = 0, self.data[context:] if context else self.data
        for end, token in enc.ending.iter(text.decode("latin-1")):
            end += context
            if end < size:
                continue
            before = end - enc.sizes[token]
            if before >= 0 and not enc.stay_apart(last[before], token):
                continue
            last.append(token)
            size += 1
            if end >= tail:
                # all tokens that may end further on lie in unchanged bytes, and so do the entries they follow
                agreed = agreed + 1 if old and old[end - tail] == token else 0
                if agreed >= enc.longest:
                    last.extend(old[end - tail + 1:])
                    break
        self.computed += size - first
        if len(last) != len(self.data):
            raise ValueError("a prefix has no encoding")

    def ids(self) -> list[int]:
        return self.encoder.read_back(self.last)


class EncodedText:
    """A text with the ids of its pieces; edits re-encode only pieces near them."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.starts: list[int] = []
        self.parts: list[bytes] = []
        self.tables: dict[int, Prefixes] = {}  # of long pieces, by start
        self.replace(0, 0, text)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Characters [start, end) become ``new``; the number of pieces encoded again."""
        old, starts, delta = self.text, self.starts, len(new) - (end - start)
        # a piece is as before if all the pattern looked at is: up to LOOKAHEAD beyond its end
        first = 0
        if starts:
            first = max(0, bisect_right(starts, start - LOOKAHEAD) - 1)
        at = starts[first] if starts else 0
        self.text = old[:start] + new + old[end:]
        fresh_starts, fresh_parts, tables = [], [], {s: t for s, t in self.tables.items() if s < at}
        rest = len(starts)
        for m in self.encoder.pattern.finditer(self.text, at):
            # from the start of an old piece behind the edit on, all pieces are the old ones
            back = m.start() - delta
            if m.start() >= start + len(new) and back >= end:
                k = bisect_left(starts, back)
                if k < len(starts) and starts[k] == back:
                    rest = k
                    break
            fresh_starts.append(m.start())
            fresh_parts.append(self._part(m.group(), self.tables.get(m.start()), m.start(), tables))
        if rest < len(starts):
            tables |= {s + delta: t for s, t in self.tables.items() if s >= starts[rest]}
        self.starts = starts[:first] + fresh_starts + [s + delta for s in starts[rest:]]
        self.parts = self.parts[:first] + fresh_parts + self.parts[rest:]
        self.tables = tables
        return len(fresh_parts)

    def _part(self, piece: str, table: Prefixes | None, start: int, tables: dict[int, Prefixes]) -> bytes:
        if len(piece) < LONG_PIECE:
            return self.encoder.known[piece]
        data = piece.encode()
        if table is None:
            table = Prefixes(self.encoder, data)
        else:
            table.become(data)
        tables[start] = table
        whole = self.encoder.ranks.get(data)
        return array("i", [whole] if whole is not None else table.ids()).tobytes()

    def ids(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.parts), np.int32)


@functools.cache
def _vocabulary(path: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    tokens = read_ranks(path)
    return tokens, *last_merges(tokens)


def _shipped(spark: SparkSession, path: str, pattern: str | None):
    """A broadcast of plain values that an encoder is built from (its size is the vocabulary's)."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    return spark.sparkContext.broadcast((*_vocabulary(path), pattern))


def _ids_batches(batches: Iterator[pa.RecordBatch], shipped, ids_of) -> Iterator[pa.RecordBatch]:
    """``doc_id, ids`` of every row, by ``ids_of(encoder, row)``."""
    encoder = Encoder(*shipped.value)
    for batch in batches:
        doc_ids, columns = batch.column("doc_id").cast(pa.int64()), [c for c in batch.schema.names if c != "doc_id"]
        held, sizes, at, total = [], [], 0, 0
        for i in range(batch.num_rows):
            ids = ids_of(encoder, *(batch.column(c)[i].as_py() for c in columns))
            held.append(ids)
            sizes.append(len(ids))
            total += len(ids)
            if total >= IDS_PER_BATCH or i + 1 == batch.num_rows:
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
                                                 pa.array(np.concatenate(held).astype(np.int32, copy=False)))
                yield pa.RecordBatch.from_arrays([doc_ids.slice(at, i + 1 - at), lists], names=["doc_id", "ids"])
                held, sizes, at, total = [], [], i + 1, 0


def encode_documents(docs: DataFrame, path: str, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids`` (array of int) of every row of ``docs`` by the ranks in ``path``."""
    shipped = _shipped(docs.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _ids_batches(batches, shipped, lambda encoder, text: encoder.ids(text or ""))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def encode_edits(docs: DataFrame, path: str, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids`` of texts after their ``edits``, an array of (start, length, insert)
    in characters, applied in order; what an edit leaves alone is not encoded again.
    Null edits are none, a null insert is empty, places beyond the end mean the end."""
    shipped = _shipped(docs.sparkSession, path, pattern)

    def edited(encoder: Encoder, text: str | None, edits: list | None) -> np.ndarray:
        state = EncodedText(encoder, text or "")
        for e in edits or []:
            start = min(max(e["start"] or 0, 0), len(state.text))
            state.replace(start, min(start + max(e["length"] or 0, 0), len(state.text)), e["insert"] or "")
        return state.ids()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _ids_batches(batches, shipped, edited)

    rows = docs.select("doc_id", "text", F.col("edits").cast("array<struct<start:int,length:int,insert:string>>").alias("edits"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, data``: the bytes (binary) that the ids of every row stand for; null ids give none."""
    shipped = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shipped.value.__getitem__
        for batch in batches:
            lists = batch.column("ids")
            # some rows at a time: their bytes are larger than their ids
            step = max(1, batch.num_rows * IDS_PER_BATCH // max(len(lists.flatten()), 1))
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                data = [b"".join(map(token, ids.values.to_numpy(zero_copy_only=False).tolist())) if ids.is_valid else b""
                        for ids in rows.column("ids")]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("ids"), pa.array(data, pa.binary())],
                                                 names=["doc_id", "ids", "data"])

    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, ids array<int>, data binary")
