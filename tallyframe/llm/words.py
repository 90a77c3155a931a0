"""Words and word shingles of whole Arrow batches of texts, as numpy arrays.

A word is a run of ASCII letters and digits and of any bytes outside ASCII in the UTF-8 text, with
A-Z lower-cased; as a pattern, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing. Words are
represented by 64-bit hashes, so equality of words is equality of hashes.

Work goes on in chunks of whole documents of about half a megabyte: memory follows the chunk, or the one
document that is longer than that, never the batch. Null texts are empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_LETTER = np.arange(256)
_UPPER = (_LETTER >= 65) & (_LETTER <= 90)
LOWERED = np.where(_UPPER, _LETTER + 32, _LETTER).astype(np.uint8)
IS_WORD = (
    ((_LETTER >= 48) & (_LETTER <= 57)) | ((_LETTER >= 97) & (_LETTER <= 122)) | _UPPER | (_LETTER >= 128)
)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit integers, the same on every machine."""
    start = np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start)


#: What a byte counts in the hash of its word; a capital counts as its small letter.
_VALUE = stream(1, 256)[LOWERED]
_BASE = int(stream(2, 1)[0]) | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)

    return of(_BASE), of(_BASE_INVERSE)


@dataclass
class Words:
    """The words of consecutive documents ``first .. first + n_docs`` of a batch."""

    first: int
    n_docs: int
    hashes: np.ndarray  # uint64, a word each, in text order
    begins: np.ndarray  # begins[d]:begins[d + 1] are the words of document d
    starts: np.ndarray  # byte offsets into data
    ends: np.ndarray
    data: np.ndarray  # the chunk's bytes
    offsets: np.ndarray  # offsets[d]:offsets[d + 1] are the bytes of document d

    @property
    def docs(self) -> np.ndarray:
        """The document of each word, counted from ``first``."""
        return np.repeat(np.arange(self.n_docs), np.diff(self.begins))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts, and the offsets of each text in them."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at


def byte_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of its first text, bytes, offsets) of chunks of whole texts of about ``limit`` bytes."""
    data, at = text_bytes(texts)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Words]:
    for first, data, offsets in byte_chunks(texts, limit):
        yield split_words(first, data, offsets)


def split_words(first: int, data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    n_docs = len(offsets) - 1
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(first, n_docs, np.zeros(0, np.uint64), np.zeros(n_docs + 1, np.int64), none, none, data, offsets)
    inside = IS_WORD[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    # A text begins and ends its words, whatever the next one starts with.
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    power, inverse = _powers(1 << max(19, int(n).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[:n], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return Words(first, n_docs, hashes, np.searchsorted(starts, offsets), starts, ends, data, offsets)


_PLACE = stream(3, 64) | np.uint64(1)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit hash) of every run of ``n`` words; a text of fewer words, but not none, is one run."""
    count = np.diff(words.begins)
    stops = words.begins[1:]
    stop = np.repeat(stops, count)
    at = np.arange(len(words.hashes))
    full = (at + n <= stop) | (at == np.repeat(words.begins[:-1], count))
    at, stop = at[full], stop[full]
    total = np.zeros(len(at), np.uint64)
    for j in range(n):
        there = at + j < stop
        if there.all():
            total += words.hashes[at + j] * _PLACE[j]
        else:
            total[there] += words.hashes[at[there] + j] * _PLACE[j]
    return np.repeat(np.arange(words.n_docs), count)[full], mixed(total)


#: Shingle ids have 48 bits, so that they sort together with 16 bits for a document of the chunk.
SHINGLE_BITS = 48
_MAX_DOCS = 1 << (64 - SHINGLE_BITS)


def shingle_counts(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document with their counts: (bounds by document, ids in order, counts)."""
    docs, hashes = shingles(words, n)
    ids = hashes >> np.uint64(64 - SHINGLE_BITS)
    parts_ids, parts_counts, lengths = [], [], np.zeros(words.n_docs, np.int64)
    for low in range(0, max(words.n_docs, 1), _MAX_DOCS):
        high = min(words.n_docs, low + _MAX_DOCS)
        here = slice(*np.searchsorted(docs, [low, high]))
        keys = np.sort(((docs[here] - low).astype(np.uint64) << np.uint64(SHINGLE_BITS)) | ids[here])
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        distinct = keys[new]
        lengths[low:high] = np.bincount((distinct >> np.uint64(SHINGLE_BITS)).astype(np.int64), minlength=high - low)
        parts_ids.append(distinct & np.uint64((1 << SHINGLE_BITS) - 1))
        parts_counts.append(np.diff(np.append(new, len(keys))))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    return bounds, np.concatenate(parts_ids), np.concatenate(parts_counts)


def list_array(bounds: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
