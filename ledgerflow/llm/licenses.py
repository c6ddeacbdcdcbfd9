"""Licence notices in documents: MinHash bands retrieve, exact containment verifies.

Words are runs of letters and digits (ASCII letters lower-cased, bytes of other
characters count as letters); a template of L shingles of k words (fewer if it
has fewer) is looked for in windows of two blocks of shingles, a block as long
as the largest occurrence, so any occurrence lies in one window whole.  A
window that contains the share t of a template has a Jaccard similarity to it
of at least j = ceil(tL) / (2 block + L - ceil(tL)); the number of bands is the
least for which the chance that no band agrees, (1 - j^rows)^bands, is below
``miss``.  Windows that agree in a band are verified on their shingles, exactly.

Consecutive windows that hold the same template are one match, from the first
to the last of its words there.  Null and empty texts have no match; repeated
rows are scanned one by one; tables without rows give no rows; other columns
are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textops import mix, shingle_hashes, slices, text_bytes, word_hashes

#: Not a letter, not a digit: between words.
_BETWEEN = np.ones(256, bool)
_BETWEEN[48:58] = _BETWEEN[65:91] = _BETWEEN[97:123] = False
_BETWEEN[128:] = False

#: Names and texts of public licence notices.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, "
                         "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                         "CONDITIONS OF ANY KIND, either express or implied.",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                      "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                      "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
                      "the Software, and to permit persons to whom the Software is furnished to do so.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                  "later version.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                          "that the following conditions are met.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
               "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "all-rights-reserved": "All rights reserved.",
}


def bands_for(similarity: float, rows: int, miss: float) -> int:
    """The least number of bands of ``rows`` hashes for which a pair of at least this
    similarity agrees in none with a chance below ``miss``."""
    p = similarity ** rows
    return 1 if p >= 1 else math.ceil(math.log(miss) / math.log1p(-p))


@dataclass(frozen=True)
class Group:
    """Templates that share shingle length, block length and band settings."""

    k: int
    block: int
    bands: int
    names: tuple[str, ...]
    shingles: tuple[np.ndarray, ...]
    bounds: np.ndarray  # bands x templates: a template's value in each band


def _hashes(text: str, k: int) -> tuple[np.ndarray, int]:
    raw, offsets = text_bytes(pa.array([text]))
    words = word_hashes(raw, offsets, between=_BETWEEN)[0]
    k = min(k, len(words))
    return np.unique(shingle_hashes(words, k)) if k else np.zeros(0, np.uint64), k


def _band_values(mins: list[np.ndarray]) -> np.ndarray:
    out = np.zeros_like(mins[0])
    for m in mins:
        out = mix(out ^ m)
    return out


def _permuted(shingles: np.ndarray, number: int) -> np.ndarray:
    """Order of the shingles in permutation ``number``: their hashes are random, so which one is
    nearest to a random point in the order of bits is so too."""
    return shingles ^ mix(np.array([number + 1], np.uint64))[0]


def compile_templates(templates: Mapping[str, str], k: int = 5, containment: float = 0.8, rows: int = 1,
                      miss: float = 1e-4) -> list[Group]:
    """Templates by size class, so that windows are never much larger than what they hold."""
    classes = defaultdict(list)
    for name, text in templates.items():
        shingles, own_k = _hashes(text, k)
        if own_k:
            size = math.ceil(2 * math.log2(len(shingles)))
            classes[own_k, math.ceil(2 ** (size / 2) / containment)].append((name, shingles))
    out = []
    for (own_k, block), members in sorted(classes.items()):
        least = min(math.ceil(containment * len(s) - 1e-9) / (2 * block + len(s) - math.ceil(containment * len(s) - 1e-9)) for _, s in members)
        bands = bands_for(least, rows, miss)
        bounds = np.stack([_band_values([np.array([_permuted(s, b * rows + r).min() for _, s in members]) for r in range(rows)])
                           for b in range(bands)])
        out.append(Group(own_k, block, bands, tuple(n for n, _ in members), tuple(s for _, s in members), bounds))
    return out


def _matches(g: Group, words: np.ndarray, doc: np.ndarray, rows: int, containment: float) -> Iterator[tuple]:
    """(document, template, first word, last word, containment) of verified windows."""
    if len(words) < g.k:
        return
    shingles = shingle_hashes(words, g.k)
    n = len(shingles)
    whole = doc[:n] == doc[g.k - 1:g.k - 1 + n]
    first_word = np.searchsorted(doc, np.arange(int(doc[-1]) + 2))
    place, owner, shingles = np.arange(n)[whole], doc[:n][whole], shingles[whole]
    if not len(shingles):
        return
    block = (place - first_word[owner]) // g.block
    head = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (block[1:] != block[:-1]))))
    tail = np.append(head[1:], len(shingles))
    paired = np.zeros(len(head), bool)
    paired[:-1] = owner[head[1:]] == owner[head[:-1]]
    found: set[tuple[int, int]] = set()
    for band in range(g.bands):
        mins = []
        for r in range(rows):
            least = np.minimum.reduceat(_permuted(shingles, band * rows + r), head)
            least[:-1] = np.where(paired[:-1], np.minimum(least[:-1], least[1:]), least[:-1])
            mins.append(least)
        value = _band_values(mins)
        order = np.argsort(g.bounds[band], kind="stable")
        bounds = g.bounds[band][order]
        lo, hi = np.searchsorted(bounds, value), np.searchsorted(bounds, value, "right")
        for w in np.flatnonzero(hi > lo):
            found.update((int(order[t]), int(w)) for t in range(lo[w], hi[w]))
    run: list | None = None
    for t, w in sorted(found):
        a, z = int(head[w]), int(tail[w + 1] if paired[w] else tail[w])
        window = shingles[a:z]
        inside = np.isin(window, g.shingles[t])
        share = len(np.unique(window[inside])) / len(g.shingles[t])
        if share < containment - 1e-9:
            continue
        at = place[a:z][inside]
        start, end = int(at[0] - first_word[owner[a]]), int(at[-1] - first_word[owner[a]]) + g.k
        if run and run[0] == t and run[1] == w - 1 and run[2] == int(owner[a]) and start < run[4]:
            run[1], run[4], run[5] = w, max(run[4], end), max(run[5], share)
            run[3] = min(run[3], start)
        else:
            if run:
                yield run[2], g.names[run[0]], run[3], run[4], run[5]
            run = [t, w, int(owner[a]), start, end, share]
    if run:
        yield run[2], g.names[run[0]], run[3], run[4], run[5]


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = NOTICES, k: int = 5, containment: float = 0.8,
                  rows: int = 1, miss: float = 1e-4) -> DataFrame:
    """``doc_id, license, start_word, end_word, containment``: a row per match."""
    groups = compile_templates(templates, k, containment, rows, miss)
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()),
                        ("containment", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            out = []
            for s, e in slices(offsets, 1 << 20):
                words, doc, _, _ = word_hashes(raw, offsets[s:e + 1], between=_BETWEEN)
                if len(words):
                    for g in groups:
                        out += [(ids[s + d], *rest) for d, *rest in _matches(g, words, doc, rows, containment)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, license string, start_word long, end_word long, containment double")
