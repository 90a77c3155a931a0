"""Benchmark decontamination: verbatim passages of test items found through suffix arrays.

Every batch of documents is cut into shards of about two megabytes, and each shard's words get a
suffix array: all word positions in the order of the text that follows them. Every suffix of the
test items that can start a window is looked up by binary search, which yields the run of the array
that holds all its occurrences. Those runs give the words hit and, extended word by word, the
longest match of each item with each document.

A window is ``n`` consecutive words of an item; an item of fewer words, but not none, is one window.
Words are those of ``words``. The arrays sort by as many words as the longest window needs (27 for the usual
ten), which is all that the binary search reads.

Defined results: null and empty texts have no words and no hits; an item without words has no
window; repeated items with the same id count once, and an item without id marks words as hit but is
not listed. Ids that are not integers are taken as text. Repeated documents are answered row by row. An empty benchmark hits nothing.

The test items reach the tasks as broadcast blocks of at most ``BLOCK_BYTES`` of text each (and one
item more); repeated items are folded first. A benchmark of more than one block takes a pass over the documents for each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.staging import Workspace, columns_of, fresh
from tallyframe.llm.words import Words, split_words, text_bytes, word_chunks
from tallyframe.operators.running import with_running_totals

SHARD_BYTES = 2 << 20
BLOCK_BYTES = 8 << 20
_PAIRS_AT_ONCE = 1 << 20


def found_type(id_type: str = "bigint") -> str:
    return (
        "struct<n_words:bigint,spans:array<int>,"
        f"matches:array<struct<item_id:{id_type},length:int,doc_word:int,item_word:int>>>"
    )


@dataclass
class TestSet:
    """Test items as word hashes; suffixes that can start a window, grouped by the window's text."""

    ids: pa.Array  # of whole numbers or text, an item each
    hashes: np.ndarray  # all words
    item: np.ndarray  # the item of each word
    stop: np.ndarray  # where the item of each word ends
    window_at: np.ndarray  # a suffix for each distinct window
    window_words: np.ndarray  # the words of each distinct window
    bounds: np.ndarray  # suffixes[bounds[w]:bounds[w + 1]] start with window w
    suffixes: np.ndarray


def build_test_set(ids: pa.Array, texts: pa.Array, n: int) -> TestSet:
    words = split_words(0, *(lambda data, at: (data[at[0] : at[-1]], at - at[0]))(*text_bytes(texts)))
    item = words.docs
    stop = words.begins[1:][item]
    first = words.begins[:-1][item]
    at = np.arange(len(item))
    need = np.minimum(n, stop - first)
    can = (at + n <= stop) | (at == first)
    at, need = at[can], need[can]
    # Windows are equal if they have as many words and the same ones.
    table = np.zeros((len(at), n + 1), np.uint64)
    table[:, n] = need
    for j in range(n):
        there = need > j
        table[there, j] = words.hashes[at[there] + j]
    _, one, window = np.unique(table, axis=0, return_index=True, return_inverse=True)
    window = window.reshape(-1)
    order = np.argsort(window, kind="stable")
    bounds = np.searchsorted(window[order], np.arange(len(one) + 1))
    return TestSet(ids, words.hashes, item, stop, at[one], need[one], bounds, at[order])


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in the order of their keys, rank of each position; equal keys share a rank, from 1)."""
    order = np.argsort(keys)
    in_order = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.concatenate(([1], in_order[1:] != in_order[:-1]))) if len(keys) else 0
    return order, rank


def suffix_array(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Positions of a sequence of small positive integers (0 ends a text), ordered by the next ``depth`` of them.

    Ranks of runs are combined into ranks of runs two or three times as long until those are long enough.
    """
    bits = int(max(len(sequence) + 1, sequence.max(initial=0) + 1)).bit_length()
    parts = 3 if 3 * bits <= 63 else 2
    rank, reach = sequence, 1
    order = None
    while order is None or reach < depth:
        key = rank << (bits * (parts - 1))
        for j in range(1, parts):
            key[: -j * reach or None] |= rank[j * reach :] << (bits * (parts - 1 - j))
        order, rank = ranked(key)
        reach *= parts
    return order


def _search(array: np.ndarray, text: np.ndarray, query: np.ndarray, at: np.ndarray, need: np.ndarray, past: bool) -> np.ndarray:
    """By binary search: the first place of ``array`` whose suffix is not below (``past``: is above) the first ``need`` words at ``at``."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(array), np.int64)
    longest = int(need.max(initial=0))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        suffix = array[np.minimum(middle, len(array) - 1)]
        order = np.zeros(len(at), np.int8)
        for d in range(longest):
            undecided = np.flatnonzero((order == 0) & (need > d) & open_)
            if not len(undecided):
                break
            here = suffix[undecided] + d
            theirs = np.where(here < len(text), text[np.minimum(here, len(text) - 1)], 0)
            order[undecided] = np.sign(theirs - query[at[undecided] + d])
        below = (order <= 0 if past else order < 0) & open_
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for counts[i] places, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Shard:
    """Documents as one sequence of word ranks, each text ended by 0, with the suffix array over it."""

    def __init__(self, words: Words, depth: int) -> None:
        self.n_docs = words.n_docs
        self.order, rank = ranked(words.hashes)
        self.vocabulary = words.hashes[self.order][np.flatnonzero(np.diff(rank[self.order], prepend=0))]
        lengths = np.diff(words.begins)
        self.begins = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.text = np.zeros(int(self.begins[-1]), np.int64)
        self.text[np.arange(len(rank)) + np.repeat(np.arange(words.n_docs), lengths)] = rank
        self.array = suffix_array(self.text, depth)

    def query(self, hashes: np.ndarray) -> np.ndarray:
        """Test words as the ranks they have here, or -1."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, -1)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, position, "right") - 1


def _lengths(shard: Shard, query: np.ndarray, test: TestSet, position: np.ndarray, suffix: np.ndarray, words: np.ndarray) -> np.ndarray:
    """How many words each document position and test suffix have in common, ``words`` at least."""
    length = words.copy()
    going = np.arange(len(position))
    while len(going):
        d = length[going]
        inside = suffix[going] + d < test.stop[suffix[going]]
        going, d = going[inside], d[inside]
        same = shard.text[position[going] + d] == query[suffix[going] + d]
        going = going[same]
        length[going] += 1
    return length


def search_shard(words: Words, test: TestSet, spans: list[np.ndarray] | None = None):
    """Hits in each document of the shard: (spans as start, end pairs; matches as item, length, document word, item word)."""
    shard = Shard(words, int(test.window_words.max(initial=1)))
    query = shard.query(test.hashes)
    absent = np.concatenate(([0], np.cumsum(query < 0)))
    whole = absent[test.window_at + test.window_words] == absent[test.window_at]
    window = np.flatnonzero(whole)
    at, need = test.window_at[window], test.window_words[window]
    low = _search(shard.array, shard.text, query, at, need, past=False)
    count = _search(shard.array, shard.text, query, at, need, past=True) - low
    found = np.flatnonzero(count)
    window, need, low, count = window[found], need[found], low[found], count[found]
    occurs = shard.array[_spread(low, count)]  # every occurrence of every window found
    of = np.repeat(np.arange(len(window)), count)

    change = np.zeros(len(shard.text) + 1, np.int64)
    np.add.at(change, occurs, 1)
    np.add.at(change, occurs + need[of], -1)
    if spans is not None:
        for d, known in enumerate(spans):
            np.add.at(change, shard.begins[d] + known[0::2], 1)
            np.add.at(change, shard.begins[d] + known[1::2], -1)
    hit = np.cumsum(change[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]

    # Longest match of each item with each document: of all places where one cannot start earlier.
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    suffixes = np.diff(test.bounds)[window]
    pairs = suffixes[of]
    for part in np.array_split(np.arange(len(of)), max(1, -(-int(pairs.sum()) // _PAIRS_AT_ONCE))):
        position = np.repeat(occurs[part], pairs[part])
        suffix = test.suffixes[_spread(test.bounds[window[of[part]]], pairs[part])]
        length = np.repeat(need[of[part]], pairs[part])
        before = (suffix > 0) & (position > 0)
        before &= np.where(before, test.item[suffix - 1] == test.item[suffix], False)
        before &= np.where(before, query[suffix - 1] == shard.text[position - 1], False)
        position, suffix, length = position[~before], suffix[~before], length[~before]
        length = _lengths(shard, query, test, position, suffix, length)
        doc, item = shard.doc_of(position), test.item[suffix]
        order = np.lexsort((suffix, position, -length, item, doc))
        key = doc[order] * len(test.ids) + item[order]
        first = order[np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))] if len(order) else order
        for i in first.tolist():
            d, k = int(doc[i]), int(item[i])
            start = int(suffix[i])
            new = (-int(length[i]), int(position[i] - shard.begins[d]), start)
            if (d, k) not in best or new < best[d, k]:
                best[d, k] = new
    return begin - shard.begins[shard.doc_of(begin)], end - shard.begins[shard.doc_of(begin)], shard.doc_of(begin), best


def search_texts(texts: pa.Array, test: TestSet, known: pa.Array | None = None) -> pa.Array:
    """The found struct of each text; ``known`` has spans found before, which stay hit."""
    starts = np.concatenate(([0], np.cumsum(np.bincount(test.item, minlength=len(test.ids))))) if len(test.ids) else None
    n_words, span_counts, span_values, match_counts, matches = [], [], [], [], []
    for words in word_chunks(texts, SHARD_BYTES):
        old = None
        if known is not None:
            old = [np.asarray(known[words.first + d].as_py() or [], np.int64) for d in range(words.n_docs)]
        begin, end, doc, best = search_shard(words, test, old)
        n_words.append(np.diff(words.begins))
        span_counts.append(2 * np.bincount(doc, minlength=words.n_docs))
        span_values.append(np.stack((begin, end), 1).reshape(-1))
        per_doc = np.zeros(words.n_docs, np.int64)
        for (d, k), (length, at, suffix) in sorted(best.items()):
            per_doc[d] += 1
            matches.append((test.ids[k].as_py(), -length, at, suffix - int(starts[k])))
        match_counts.append(per_doc)
    none = [np.zeros(0, np.int64)]

    def bounds(counts: list[np.ndarray]) -> pa.Array:
        return pa.array(np.concatenate(([0], np.cumsum(np.concatenate(none + counts)))), pa.int32())

    columns = list(zip(*matches)) if matches else [[], [], [], []]
    match = pa.StructArray.from_arrays(
        [pa.array(columns[0], test.ids.type), *[pa.array(c, pa.int32()) for c in columns[1:]]],
        ["item_id", "length", "doc_word", "item_word"],
    )
    return pa.StructArray.from_arrays(
        [
            pa.array(np.concatenate(none + n_words), pa.int64()),
            pa.ListArray.from_arrays(bounds(span_counts), pa.array(np.concatenate(none + span_values), pa.int32())),
            pa.ListArray.from_arrays(bounds(match_counts), match),
        ],
        ["n_words", "spans", "matches"],
    )


def with_matches(docs: DataFrame, benchmark: DataFrame, name: str = "found", n: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with a column ``name`` of ``found_type``: words, spans of words hit, longest match by item.

    ``docs`` needs ``text``, ``benchmark`` needs ``item_id`` and ``text``; other columns stay as they are.
    """
    spark = docs.sparkSession
    whole = isinstance(benchmark.schema["item_id"].dataType, T.IntegralType)
    id_type, types = ("bigint", (pa.int64(), pa.string())) if whole else ("string", (pa.string(), pa.string()))
    items = benchmark.select(F.col("item_id").cast(id_type).alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    items = items.withColumn("bytes", F.octet_length("text").cast("bigint"))
    size = items.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    work = Workspace(spark, "decontaminate")
    if size > block_bytes:
        # Items of whole blocks by running bytes; a row that passes the end of a block still belongs to it.
        upto = with_running_totals(items, [F.md5("text"), F.col("item_id")], {"upto": "bytes"})
        items = work.keep(upto.withColumn("block", F.floor((F.col("upto") - F.col("bytes")) / block_bytes).cast("int")))
    blocks = [r[0] for r in items.select("block").distinct().collect()] if size > block_bytes else [None]
    out = docs
    for b in sorted(blocks) if size > block_bytes else blocks:
        rows = (items if b is None else items.where(F.col("block") == b)).select("item_id", "text").toArrow().combine_chunks()
        ids, texts = (pa.concat_arrays(rows[c].chunks) if rows.num_rows else pa.array([], t) for c, t in zip(("item_id", "text"), types))
        test = spark.sparkContext.broadcast(build_test_set(ids, texts, n))
        out = out.withColumn(name, _searched(test, id_type) if out is docs else _searched_again(test, name, id_type))
        if b is not None:
            out = work.keep(out)
    return out


def _searched(test, id_type: str) -> Column:
    @F.arrow_udf(found_type(id_type))
    def search(texts: pa.Array) -> pa.Array:
        return search_texts(texts, test.value)

    return search(F.col("text"))


def _searched_again(test, name: str, id_type: str) -> Column:
    @F.arrow_udf(found_type(id_type))
    def search(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return search_texts(texts, test.value, spans)

    old = F.col(f"`{name}`")
    new = search(F.col("text"), old["spans"])
    return F.struct(
        new["n_words"].alias("n_words"),
        new["spans"].alias("spans"),
        F.concat(old["matches"], new["matches"]).alias("matches"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (distinct, as text, in order), matches."""
    found = F.col("found")
    flips = F.transform(found["spans"], lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return with_matches(docs.select("doc_id", "text"), benchmark, n=n).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        F.aggregate(flips, F.lit(0).cast("bigint"), lambda total, x: total + x).alias("n_hit"),
        F.array_sort(
            F.array_distinct(F.array_compact(F.transform(found["matches"], lambda m: m["item_id"].cast("string"))))
        ).alias("item_ids"),
        found["matches"].alias("matches"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The documents that no window occurs in, with their columns."""
    (name,) = fresh(docs, "found")
    found = with_matches(docs, benchmark, name, n)
    return found.where(F.size(F.col(f"`{name}`.spans")) == 0).select(*columns_of(docs))
