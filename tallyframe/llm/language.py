"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A run of three letters (a word edge counts as a letter) is
the product of its letters' vectors, each rotated by its place in the run, and a text is the sum of its
runs' vectors. A language's prototype bundles what its training documents have, each document scaled to
length one; a text belongs to the language whose prototype has the greatest cosine with it.

The vectors of all documents are centred by the mean prototype, which takes away what all the languages
share. Scores are the chosen language's part of exp(cosine * SHARPNESS) over all the languages.

Letters are Unicode letters of the lower-cased text; anything else separates words.

Defined results: a text that is null or has no letters is ``und`` with score 0, and so is every text if
there is nothing to learn from. Ties go to the language first in code point order.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.words import byte_chunks, stream

DIMENSION = 1024
UNKNOWN = "und"
SHARPNESS = 20.0
_EDGE = 32
_TEXTS_AT_ONCE = 512


@lru_cache(maxsize=8192)
def _letter(code: int, place: int) -> np.ndarray:
    """The letter's random vector, rotated by its place."""
    bits = np.unpackbits(stream(100 + code, DIMENSION // 64).view(np.uint8))
    return np.roll(bits.astype(np.int8) * 2 - 1, place)


_runs: dict[int, np.ndarray] = {}


def _run(run: int) -> np.ndarray:
    """The bound vector of three letters, packed 21 bits each; the vectors of common runs are kept."""
    found = _runs.get(run)
    if found is None:
        found = _letter(run >> 42, 2) * _letter(run >> 21 & 0x1FFFFF, 1) * _letter(run & 0x1FFFFF, 0)
        if len(_runs) >= 50_000:
            _runs.clear()
        _runs[run] = found
    return found


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For each code point its small letter, or a word edge if it is no letter."""
    out = np.full(0x110000, _EDGE, np.uint32)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and (text := chr(code)).isalpha():
            small = text.lower()
            out[code] = ord(small) if len(small) == 1 else code
    return out


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, run, count), distinct and ordered, of a chunk of fewer than 2**16 texts in UTF-8."""
    # Texts are decoded together, each ended by a word edge.
    cut = np.insert(data, offsets[1:], _EDGE)
    codes = np.frombuffer(cut.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    letters = _folded()[codes]
    ends = np.cumsum((cut & 0xC0) != 0x80)[offsets[1:] + np.arange(len(offsets) - 1)]
    doc = np.repeat(np.arange(len(ends), dtype=np.uint64), np.diff(ends, prepend=0))
    # Letters are numbered within the chunk, so that a document and a run fit one sortable integer.
    seen = np.zeros(0x110000, bool)
    seen[letters] = True
    seen[_EDGE] = True
    names = np.flatnonzero(seen)
    number = (np.cumsum(seen, dtype=np.int32) - 1).astype(np.uint64)[letters]
    edge = np.uint64(np.searchsorted(names, _EDGE))
    before, after = np.concatenate(([edge], number[:-1])), np.concatenate((number[1:], [edge]))
    key = (doc << np.uint64(48)) | (before << np.uint64(32)) | (number << np.uint64(16)) | after
    key = np.sort(key[number != edge])
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    key, count = key[new], np.diff(np.append(new, len(key)))
    three = [names[((key >> np.uint64(k)) & np.uint64(0xFFFF)).astype(np.int64)] for k in (32, 16, 0)]
    return (key >> np.uint64(48)).astype(np.int64), (three[0] << 42) | (three[1] << 21) | three[2], count


def text_vectors(texts: pa.Array):
    """(index of its first text, vectors of length 1 of the texts, whether each has letters), for parts of the texts."""
    for first, data, offsets in byte_chunks(texts, 1 << 19):
        for low in range(0, len(offsets) - 1, _TEXTS_AT_ONCE):
            at = offsets[low : low + _TEXTS_AT_ONCE + 1]
            doc, run, count = letter_runs(data[at[0] : at[-1]], at - at[0])
            names = np.sort(run)
            names = names[np.flatnonzero(np.diff(names, prepend=-1))]
            counts = np.zeros((len(at) - 1, len(names)), np.float32)
            counts[doc, np.searchsorted(names, run)] = count
            table = np.stack([_run(r) for r in names.tolist()]) if len(names) else np.zeros((0, DIMENSION), np.int8)
            out = counts @ table.astype(np.float32)
            length = np.linalg.norm(out, axis=1, keepdims=True)
            yield first + low, out / np.maximum(length, 1e-9), counts.any(1) if len(names) else np.zeros(len(out), bool)


class Prototypes:
    def __init__(self, names: list[str], sums: np.ndarray) -> None:
        order = np.argsort(names)
        self.names = [names[i] for i in order]
        unit = sums[order] / np.maximum(np.linalg.norm(sums[order], axis=1, keepdims=True), 1e-9)
        self.shared = unit.mean(0) if len(names) > 1 else np.zeros(DIMENSION)
        centred = unit - self.shared
        self.vectors = (centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        said, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.names:
            return said, score
        for first, vectors, lettered in text_vectors(texts):
            centred = vectors - self.shared.astype(np.float32)
            centred /= np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-9)
            cosine = (centred @ self.vectors.T).astype(np.float64)
            best = cosine.argmax(1)
            part = 1 / np.exp((cosine - cosine.max(1, keepdims=True)) * SHARPNESS).sum(1)
            for d in np.flatnonzero(lettered).tolist():
                said[first + d], score[first + d] = self.names[best[d]], part[d]
        return said, score


def learn_prototypes(docs: DataFrame) -> Prototypes:
    """Prototypes from ``text`` and ``lang``; a task sends one sum per language, and those are added up by language."""

    def sums(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.asarray(batch.column(1).to_pylist(), object)
            for first, vectors, lettered in text_vectors(batch.column(0)):
                own = langs[first : first + len(vectors)]
                for name in set(own.tolist()):
                    total = totals.setdefault(name, np.zeros(DIMENSION))
                    total += vectors[(own == name) & lettered].sum(0, dtype=np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.string()), pa.array([t.tolist() for t in totals.values()], pa.list_(pa.float64()))],
            ["lang", "total"],
        )

    by_task = docs.where(F.col("lang").isNotNull()).select("text", "lang").mapInArrow(sums, "lang string, total array<double>")
    added = (
        by_task.select("lang", F.posexplode("total").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("total"))
        .select("lang", F.transform("total", lambda x: x["value"]).alias("total"))
    )
    rows = added.collect()  # a vector per language
    # Rounding takes away the order in which tasks were added up.
    totals = np.array([r["total"] for r in rows]).reshape(len(rows), DIMENSION).round(6)
    return Prototypes([r["lang"] for r in rows], totals)


def language(prototypes: Prototypes, spark):
    """Column function: lang_pred and score of a text."""
    known = spark.sparkContext.broadcast(prototypes)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        said, score = known.value.predict(texts)
        return pa.StructArray.from_arrays([pa.array(said, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return predict
