"""License scan: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Texts are words as in ``words``; shingles are runs of three. Templates are cut into windows of their size
class (the power of two from 8 to 128 words that holds them, 128 for longer ones), documents into
windows of every class in use, a quarter of a window apart. A window's 64 MinHash values are banded,
two to a band. A notice that a document holds whole shares at least 0.45 of its best window's shingles
with a window of the template, so one of the 32 bands agrees with probability 0.999 or more. Windows
without any shingle of any template have no band in common with one, so only the others are hashed.

Each template retrieved is verified around its windows, as far as the template is long: the share of its
shingles that occur there, counted exactly, must be ``CONTAINMENT`` or more, and those with a word of a
version or variant (any digit, or one of ``VARIANTS``) must all be there.

Defined results: null and empty texts hold no license; a template that occurs again counts once, at its
first place with the highest containment. An empty set of templates finds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyframe.llm.words import Words, mixed, shingles, stream, word_chunks

SHINGLE_WORDS = 3
CONTAINMENT = 0.8
SIZES = (8, 16, 32, 64, 128)
BANDS, ROWS = 32, 2
_SEEDS = stream(70, BANDS * ROWS)
_AT_ONCE = 1 << 12

#: Words that tell the variants of a license apart (fixed values); so do words with digits.
VARIANTS = frozenset("sa nc nd lesser library affero".split())
#: Public license notices (fixed values): short ones of the common licenses, not their full texts. Those of a
#: family share less than ``CONTAINMENT`` of their shingles.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-1.1": "Licensed under the Apache License, Version 1.1",
    "mit": "Released under the MIT License",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the Software), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "gpl-2": "GNU General Public License, version 2",
    "gpl-3": "GNU General Public License, version 3",
    "lgpl-2.1": "Lesser General Public License, version 2.1",
    "lgpl-3": "Lesser General Public License, version 3",
    "agpl-3": "Affero General Public License, version 3",
    "epl-1.0": "Eclipse Public License, version 1.0",
    "epl-2.0": "Eclipse Public License, version 2.0",
    "gpl-notice": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-nc-3.0": "Licensed under CC BY-NC 3.0",
}


def size_class(n_words: int) -> int:
    return next((s for s in SIZES if n_words <= s), SIZES[-1])


def _runs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bounds of each document's shingles, shingles in text order)."""
    doc, hashes = shingles(words, SHINGLE_WORDS)
    return np.searchsorted(doc, np.arange(words.n_docs + 1)), hashes


def window_bands(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Band keys of the windows hashes[start:stop], a row for each window."""
    out = np.zeros((len(start), BANDS), np.uint64)
    width = int((stop - start).max(initial=0))
    for low in range(0, len(start), _AT_ONCE):
        at = start[low : low + _AT_ONCE, None] + np.arange(width)
        inside = at < stop[low : low + _AT_ONCE, None]
        own = hashes[np.where(inside, at, start[low : low + _AT_ONCE, None])]
        least = np.stack([mixed(own ^ seed).min(1) for seed in _SEEDS], 1)
        folded = (least.reshape(-1, BANDS, ROWS) * (stream(71, ROWS) | np.uint64(1))).sum(2, dtype=np.uint64)
        out[low : low + _AT_ONCE] = mixed(folded + stream(72, BANDS))
    return out


def windows(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, stop) in shingles of windows of ``size`` words, a quarter of a window apart; the last may be shorter."""
    step, span = size // 4, size - SHINGLE_WORDS + 1
    count = np.diff(bounds)
    n = np.where(count > 0, np.maximum(0, -(-(count - span) // step)) + 1, 0)
    doc = np.repeat(np.arange(len(count)), n)
    start = bounds[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * step
    return doc, start, np.minimum(start + span, bounds[doc + 1])


@dataclass
class Index:
    """Bands of the templates' windows, and the templates' distinct shingles."""

    names: list[str]
    classes: list[int]
    keys: dict[int, tuple[np.ndarray, np.ndarray]]  # by size: ordered band keys and their templates
    shingles: list[np.ndarray]
    lengths: list[int]
    known: np.ndarray
    decisive: list[np.ndarray]  # the shingles of each template that hold a version or variant

    def scan(self, words: Words) -> list[tuple[int, int, float, int]]:
        """(document, template, containment, first word) of the chunk's documents."""
        bounds, hashes = _runs(words)
        if not len(self.known) or not len(hashes):
            return []
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        marked = np.concatenate(([0], np.cumsum(self.known[at] == hashes)))
        places: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for size, (keys, owners) in self.keys.items():
            doc, start, stop = windows(bounds, size)
            some = marked[stop] > marked[start]
            doc, start, stop = doc[some], start[some], stop[some]
            bands = window_bands(hashes, start, stop)
            first, last = np.searchsorted(keys, bands), np.searchsorted(keys, bands, "right")
            for w, band in zip(*np.nonzero(first < last)):
                for template in set(owners[first[w, band] : last[w, band]].tolist()):
                    places.setdefault((int(doc[w]), template), []).append((int(start[w]), int(stop[w])))
        found = []
        for (d, t), near in sorted(places.items()):
            wanted, decisive, best = self.shingles[t], self.decisive[t], (0.0, 0)
            for a, b in sorted(set(near)):
                a, b = max(bounds[d], a - self.lengths[t]), min(bounds[d + 1], b + self.lengths[t])
                there = np.isin(hashes[a:b], wanted)
                share = len(np.intersect1d(hashes[a:b][there], wanted)) / len(wanted)
                if share > best[0] and np.isin(decisive, hashes[a:b]).all():
                    best = (share, int(a + np.argmax(there) - bounds[d]))
            if best[0] >= CONTAINMENT - 1e-9:
                found.append((d, t, *best))
        return found


def build_index(templates: dict[str, str]) -> Index:
    names = sorted(templates)
    keys: dict[int, list] = {}
    parts, lengths, classes, decisive = [], [], [], []
    for t, name in enumerate(names):
        (words,) = word_chunks(pa.array([templates[name]]))
        bounds, hashes = _runs(words)
        size = size_class(len(words.hashes))
        _, start, stop = windows(bounds, size)
        keys.setdefault(size, []).append((window_bands(hashes, start, stop).reshape(-1), t))
        parts.append(np.sort(np.array(sorted(set(hashes.tolist())), np.uint64)))
        said = [words.data[a:b].tobytes().decode().lower() for a, b in zip(words.starts, words.ends)]
        telling = [i for i, w in enumerate(said) if w in VARIANTS or any(c.isdigit() for c in w)]
        at = {i for k in telling for i in range(k - SHINGLE_WORDS + 1, k + 1) if 0 <= i < len(hashes)}
        decisive.append(np.unique(hashes[sorted(at)]))
        lengths.append(len(words.hashes))
        classes.append(size)
    ordered = {}
    for size, own in keys.items():
        key = np.concatenate([k for k, _ in own])
        owner = np.concatenate([np.full(len(k), t) for k, t in own])
        order = np.argsort(key, kind="stable")
        ordered[size] = key[order], owner[order]
    known = np.array(sorted({x for p in parts for x in p.tolist()}), np.uint64)
    return Index(names, classes, ordered, parts, lengths, known, decisive)


def licenses(templates: dict[str, str] | None = None):
    """Column function: the licenses a text holds, an array of license, containment and first word.

    The index goes to the tasks with the function; it is as small as the templates are.
    """
    index = build_index(TEMPLATES if templates is None else templates)

    @F.arrow_udf("array<struct<license:string,containment:double,word:int>>")
    def scan(texts: pa.Array) -> pa.Array:
        counts, rows = np.zeros(len(texts), np.int64), []
        for words in word_chunks(texts):
            for d, t, share, word in index.scan(words):
                counts[words.first + d] += 1
                rows.append((index.names[t], share, word))
        columns = list(zip(*rows)) if rows else [[], [], []]
        values = pa.StructArray.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.int32())],
            ["license", "containment", "word"],
        )
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), values)

    return scan
