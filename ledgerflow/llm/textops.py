"""Helpers shared by the operators: Arrow text batches as byte arrays, word
hashes and shingles (numpy), shared scratch tables.

A *word* is a maximal run of characters outside ``\\x20`` and
``\\x09``-``\\x0D``.  All of these are single ASCII bytes in UTF-8, so words
are found on the bytes of a whole slice of documents at once; only A-Z are
lower-cased, as bytes too.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
#: Bytes of text that one numpy pass handles; a longer document is a pass of its own.
SLICE_BYTES = 2 << 20

_MULT = 0x9E3779B97F4A7C15 | 1


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (shared by driver and executors).

    Only a local master may lack the setting (tests); it then gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="llm-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, off, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents [start, end) with at most ``limit`` bytes, one document at least."""
    n, start = len(offsets) - 1, 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """Powers of an odd multiplier modulo 2^64."""
    out = np.full(max(n, 1), _MULT, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True, between: np.ndarray = _SPACE):
    """Words of the documents between ``offsets`` (absolute positions in ``raw``).

    ``between`` says which byte values separate words.  Returns 64-bit hashes,
    the document index of each word, and start and end byte (relative to the
    first offset).
    """
    base = int(offsets[0])
    b = raw[base:int(offsets[-1])]
    n = len(b)
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    inside = ~between[b]
    first = np.zeros(n + 1, bool)
    first[np.asarray(offsets) - base] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    if not len(starts):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    lengths = ends - starts
    # bytes of words only, each with its place inside its word
    total = int(lengths.sum())
    word_at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(total) - np.repeat(word_at, lengths)
    chars = b[inside]
    if lower:
        chars = _LOWER[chars]
    values = (chars.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[place]
    h = mix(np.add.reduceat(values, word_at) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    doc = np.searchsorted(np.asarray(offsets) - base, starts, "right") - 1
    return h, doc, starts, ends


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Order-sensitive hashes of each run of ``k`` words."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(_MULT) + h[i:i + m])
    return out


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes per document, lower-cased (A-Z).

    A document with 1 to k-1 words has its whole word sequence as one shingle,
    one without words has an empty set.
    """
    h, doc, _, _ = word_hashes(raw, offsets)
    n = len(offsets) - 1
    bounds = np.searchsorted(doc, np.arange(n + 1))
    out = []
    whole = shingle_hashes(h, k)
    for i in range(n):
        a, z = int(bounds[i]), int(bounds[i + 1])
        if z - a >= k:
            out.append(np.unique(whole[a:z - k + 1]))
        elif z > a:
            out.append(shingle_hashes(h[a:z], z - a) ^ np.uint64(z - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest_of(values: np.ndarray) -> int:
    """Signed 64-bit digest of a set of hashes (order does not matter)."""
    x = mix(values + np.uint64(0x632BE59BD9B4E019))
    return int(np.int64(mix(np.array([x.sum() + np.uint64(len(x))], np.uint64)).view(np.int64)[0]))
