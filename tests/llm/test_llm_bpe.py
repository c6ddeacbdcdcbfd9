import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward_rows, table

from ledgerflow.llm.bpe import (EncodedText, Encoder, Prefixes, decode_documents, encode_documents, encode_edits, last_merges,
                                merge_by_rank, read_ranks)

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    tokens = read_ranks(PATH)
    return Encoder(tokens, *last_merges(tokens), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_token_comes_from_its_own_merges(encoder):
    assert all(encoder.piece(t) == [i] for i, t in enumerate(encoder.tokens))
    # and by the table, without the rule for whole pieces
    assert all(Prefixes(encoder, t).ids() == [i] for i, t in list(enumerate(encoder.tokens))[::7])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("aA \n\t'sretl1é東\U0001f600-", max_size=80))
def test_texts_against_the_library(text):
    enc, lib = _both()
    assert enc.ids(text).tolist() == lib.encode_ordinary(text)


_cache = {}


def _both():
    if not _cache:
        tokens = read_ranks(PATH)
        _cache["e"] = Encoder(tokens, *last_merges(tokens), public_tokenizers.PATTERN)
        _cache["l"] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_cache["e"].ranks, special_tokens={})
    return _cache["e"], _cache["l"]


def test_every_character_is_cut_as_by_the_library(encoder, library):
    for block in range(0, 0x110000, 64):
        text = "".join(f"a {chr(c)}b {chr(c)}  {chr(c)}1" for c in range(block, block + 64) if not 0xD800 <= c < 0xE000)
        if block < 0x30000 or block % 0x4000 == 0:
            assert encoder.ids(text).tolist() == library.encode_ordinary(text), hex(block)


@pytest.mark.parametrize("seed", range(30))
def test_tables_against_merging_by_rank(seed):
    """Made-up vocabularies over two letters, where ties and overlaps are many."""
    rng = random.Random(seed)
    tokens = [bytes([b]) for b in range(256)]
    while len(tokens) < 280:
        new = rng.choice([t for t in tokens if set(t) <= set(b"ab")]) + rng.choice([t for t in tokens if set(t) <= set(b"ab")])
        if new not in tokens and merge_by_rank(new, {t: i for i, t in enumerate(tokens)}) and len(
                merge_by_rank(new, {t: i for i, t in enumerate(tokens)})) == 2:
            tokens.append(new)
    ranks = {t: i for i, t in enumerate(tokens)}
    enc = Encoder(tokens, *last_merges(tokens), ".+")
    for n in range(60):
        data = bytes(rng.choices(b"ab", k=n))
        assert Prefixes(enc, data).ids() == [ranks[p] for p in merge_by_rank(data, ranks)]


def test_a_token_without_merges_stands_for_a_whole_piece_only():
    tokens = [bytes([b]) for b in range(256)] + [b"abc"]
    enc = Encoder(tokens, *last_merges(tokens), r"\S+|\s+")
    lib = tiktoken.Encoding("tiny", pat_str=r"\S+|\s+", mergeable_ranks=enc.ranks, special_tokens={})
    for text in ("abc", "abcabc", "abc abcd xabc"):
        assert enc.ids(text).tolist() == lib.encode_ordinary(text)


def test_vocabularies_out_of_order_are_refused():
    with pytest.raises(ValueError):
        last_merges([bytes([b]) for b in range(256)] + [b"abc", b"ab"])
    with pytest.raises(ValueError):
        last_merges([b"a", b"b"])


def test_appends_are_exact(encoder):
    rng = random.Random(4)
    data = bytes(rng.choices(b"aeinrst", k=400))
    table, at = Prefixes(encoder), 0
    while at < len(data):
        step = rng.randint(1, 9)
        table.append(data[at:at + step])
        at += step
        assert table.ids() == Prefixes(encoder, data[:at]).ids()
    assert table.computed == len(data)


def test_piece_edits_compute_entries_nearby_only(encoder):
    rng = random.Random(5)
    data = bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz", k=20_000))
    table = Prefixes(encoder, data)
    for _ in range(30):
        a = rng.randrange(len(data))
        data = data[:a] + bytes(rng.choices(b"abcxyz", k=rng.randint(0, 3))) + data[a + rng.randint(0, 3):]
        before = table.computed
        table.become(data)
        assert table.computed - before < 500
        assert table.ids() == Prefixes(encoder, data).ids()


def test_text_edits_against_whole_texts(encoder):
    rng = random.Random(6)
    chars = "ab  \n\t'sre1é東-"
    for _ in range(60):
        state = EncodedText(encoder, "".join(rng.choices(chars, k=rng.randint(0, 300))))
        for _ in range(20):
            a = rng.randint(0, len(state.text))
            z = min(len(state.text), a + rng.randint(0, 6))
            state.replace(a, z, "".join(rng.choices(chars, k=rng.randint(0, 6))))
            assert state.ids().tolist() == encoder.ids(state.text).tolist()
        state.append("'re  ")
        state.append("\nx")
        assert state.ids().tolist() == encoder.ids(state.text).tolist()


def test_text_edits_leave_far_pieces(encoder):
    state = EncodedText(encoder, "some words in a row " * 2000 + "x" * 5000)
    assert state.replace(20_000, 20_003, "other") < 12
    assert state.append("yz") < 6
    assert state.replace(41_000, 41_001, "") < 6
    assert state.ids().tolist() == encoder.ids(state.text).tolist()


@pytest.mark.parametrize("text", [" " * 10 ** 6, "\n" * 10 ** 6 + "x", "a" * 300_000, "ab" * 200_000, "é" * 100_000, "=" * 300_000 + " z"])
def test_long_pieces(encoder, library, text):
    got = encoder.ids(text).tolist()
    assert encoder.decode(got) == text.encode()
    if not text.startswith((" ", "\n")):  # the library's own engine runs out of stack on these
        assert got == library.encode_ordinary(text)


def test_rows_and_their_bytes(spark, library):
    rows = awkward_rows()
    got = decode_documents(encode_documents(table(spark, rows, clashes=True), PATH), PATH).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    want = [(r[0], library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows]
    assert sorted(((r["doc_id"], r["ids"], bytes(r["data"])) for r in got), key=key) == sorted(want, key=key)
    assert decode_documents(encode_documents(table(spark, rows).limit(0), PATH), PATH).count() == 0


def test_small_batches(spark, library, monkeypatch):
    from ledgerflow.llm import bpe
    monkeypatch.setattr(bpe, "IDS_PER_BATCH", 50)
    rows = awkward_rows()
    got = decode_documents(encode_documents(table(spark, rows), PATH), PATH).collect()
    assert sorted(bytes(r["data"]) for r in got) == sorted((r[1] or "").encode() for r in rows)


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (None, [104])], "doc_id long, ids array<int>")
    assert {(r["doc_id"], bytes(r["data"])) for r in decode_documents(rows, PATH).collect()} == {(1, b""), (2, b""), (None, read_ranks(PATH)[104])}


def test_edited_rows(spark, library):
    schema = "doc_id long, text string, edits array<struct<start:int,length:int,insert:string>>, ids string"
    rows = [(1, "one two three", [(4, 3, "2"), (0, 0, "x ")], "c"), (2, None, [(5, 5, "new")], "c"), (3, "same", None, None),
            (None, "cut", [(1, 100, None)], "c"), (3, "a  b", [(2, 0, " \n"), (None, None, "é")], "c")]
    got = encode_edits(spark.createDataFrame(rows, schema), PATH).collect()
    want = [(1, "x one 2 three"), (2, "new"), (3, "same"), (None, "c"), (3, "éa  \n b")]
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == sorted((str(i), library.encode_ordinary(t)) for i, t in want)


def test_query_against_the_library(spark, library):
    from ledgerflow.llm.queries import QUERIES
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {}
    for r in docs:
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                             hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = QUERIES["op11_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want
