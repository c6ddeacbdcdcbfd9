"""Best-fit packing of tokenised documents into sequences of fixed length.

Every task is a bounded-space online best-fit packer: it holds at most
``open_bins`` open sequences, found by free space through a bitset (bit f is
set while an open sequence has f free tokens), and closes the fullest one when
it needs room.  What is left open at the end of a task is packed again, a few
tasks' leftovers together, by the same packer.

Empty and null texts are one end token.  Tables without rows give no rows;
equal texts and repeated ids are packed row by row; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
#: Arrow rows handed to one tokenizer call.
TEXTS_PER_CALL = 256
_WHITE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"  # the pattern's white space
#: Runs that are kept from the pattern; its engine's stack ends between 100,000 and 1,000,000.
LONG_RUN = 10_000
_LONG = re.compile(f"(?<!{_WHITE}){_WHITE}{{{LONG_RUN},}}")


class BestFit:
    """Online best-fit over at most ``open_bins`` open bins of ``size``.

    ``mask`` has bit f set while some open bin has f free; ``by_free[f]`` is a
    stack of these bins.  The best fit for a piece of length n is the lowest
    set bit at or above n.
    """

    def __init__(self, size: int, open_bins: int):
        self.size, self.open_bins = size, open_bins
        self.mask, self.open = 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.bins = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        bin_ = stack.pop()
        if not stack:
            self.mask &= ~(1 << free)
        self.open -= 1
        return bin_

    def put(self, n: int) -> tuple[int, int]:
        """The bin and the offset of a piece of ``n`` tokens (1 <= n <= size)."""
        fits = self.mask >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.size, self.bins
            self.bins += 1
            if n < self.size and self.open >= self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)  # the fullest closes
        left = free - n
        if left:
            self.by_free[left].append(bin_)
            self.mask |= 1 << left
            self.open += 1
        return bin_, self.size - free

    def open_ids(self) -> set[int]:
        return {b for stack in self.by_free for b in stack}


def byte_level_encoder(path: str):
    """The tokenizer file's own merges as ranks for the faster public encoder.

    The file is a byte-level BPE in the ``tokenizers`` format whose ids follow
    its merge order; results equal that library's (tested).  To this encoder
    special strings in a text are ordinary text, see :func:`encode`.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
        raise ValueError("a byte-level BPE file without normaliser is needed")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in set(printable)]
    to_byte |= {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    import public_tokenizers

    return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def added_tokens(path: str) -> dict[str, int]:
    """The tokenizer file's added tokens; only such as match as they are."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
        raise ValueError("added tokens that match as they are are needed")
    return {t["content"]: t["id"] for t in tokens}


def encode(encoder, text: str, added: dict[str, int] | None = None) -> list[int]:
    """The encoder's ids, whatever the length of white-space runs.

    Texts are split at ``added`` tokens, which get their ids, and the parts are
    encoded one by one, as the ``tokenizers`` library does by default; without
    them special strings are ordinary text (its ``encode_special_tokens``).

    The pattern ends a piece where a run begins, and takes a run whole, but for
    its last character if text follows: such a run is merged as one piece.
    """
    if added and any(t in text for t in added):
        longest = sorted(added, key=len, reverse=True)
        ids = []
        for part in re.split(f"({'|'.join(map(re.escape, longest))})", text):
            ids += [added[part]] if part in added else encode(encoder, part)
        return ids
    if len(text) < LONG_RUN:
        return encoder.encode_ordinary(text)
    ids, end = [], 0
    for m in _LONG.finditer(text):
        to = m.end() - (m.end() < len(text))
        ids += encoder.encode_ordinary(text[end:m.start()])
        ids += encoder._encode_single_piece(text[m.start():to])
        end = to
    return ids + encoder.encode_ordinary(text[end:])


_ENCODERS: dict[str, object] = {}


def _encoder(path: str):
    if path not in _ENCODERS:
        _ENCODERS[path] = byte_level_encoder(path), added_tokens(path)
    return _ENCODERS[path]


def _pieces(doc_id, ids: np.ndarray, size: int) -> Iterator[tuple]:
    """(doc_id, piece, start, length, crc): full pieces, but for a shorter first one."""
    raw, n = ids.tobytes(), len(ids)
    start, piece = 0, 0
    while start < n:
        length = (n - start) % size or size if start == 0 else size
        yield doc_id, piece, start, length, zlib.crc32(raw[4 * start:4 * (start + length)])
        start, piece = start + length, piece + 1


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2,
                   open_bins: int = 256, regroup: int = 16, special_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``docs`` has ``doc_id`` and ``text``.  Only documents longer than ``size``
    are cut.  Leftovers of ``regroup`` tasks are packed together.  With
    ``special_ids`` the file's added tokens in a text get their own ids (the
    ``tokenizers`` library's default), else they are ordinary text.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (encoder, added), packer = _encoder(tokenizer_path), BestFit(size, open_bins)
        task = TaskContext.get().partitionId()
        first = task << 33
        held: dict[int, list] = {}  # the pieces of bins that are still open
        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for at in range(0, len(ids_of), TEXTS_PER_CALL):
                texts = [t or "" for t in batch.column("text").slice(at, TEXTS_PER_CALL).to_pylist()]
                for doc_id, text in zip(ids_of[at:at + TEXTS_PER_CALL], texts):
                    ids = np.append(np.array(encode(encoder, text, added if special_ids else None), "<u4"), np.uint32(end_id)).astype("<u4")
                    for p in _pieces(doc_id, ids, size):
                        bin_, offset = packer.put(p[3])
                        row = (*p, first + bin_, offset)
                        if p[3] == size:
                            rows.append(row)
                        else:
                            held.setdefault(bin_, []).append(row)
            open_now = packer.open_ids()
            for bin_ in [b for b in held if b not in open_now]:
                rows += held.pop(bin_)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)
        # the open bins go to the second round, marked by a missing place
        rows = [(*r[:5], -1 - task // regroup, None) for rs in held.values() for r in rs]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)

    def again(table: pa.Table) -> pa.Table:
        group = -1 - table.column("sequence_id")[0].as_py()
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        packer = BestFit(size, table.num_rows)
        places = [packer.put(n) for n in table.column("length").to_pylist()]
        first = (1 << 62) + (group << 33)
        return (table.drop_columns(["sequence_id", "offset"])
                .append_column("sequence_id", pa.array([first + b for b, _ in places], pa.int64()))
                .append_column("offset", pa.array([o for _, o in places], pa.int64())))

    once = stored(docs.select("doc_id", "text").mapInArrow(packed, PIECES), "pieces")
    rest = once.where(F.col("offset").isNull()).groupBy("sequence_id").applyInArrow(again, PIECES)
    return once.where(F.col("offset").isNotNull()).unionByName(rest).select(_COLUMNS)
