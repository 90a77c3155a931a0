"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its runs of five words (all its words, if it has fewer, but not
none). The weight of a shingle is its count in the text times ``1 + idf / highest idf``, with
``idf = ln(documents / documents with the shingle)``. Two texts are linked if their weighted Jaccard
similarity is 0.8 or more; classes are the connected components of the links.

1. The document frequency of every shingle is counted over all documents. Tasks send sorted runs of
   ids with their counts, cut by ranges of ids, and a table keeps each shingle of three documents or
   more; shingles of one or two share the highest idf, which is that of two documents. The frequencies
   of at least 1 / 2**17 of all (document, shingle) pairs, of which there can be no more than 2**17, are sent to
   every task; the others are joined to the texts whose similarity is computed.
2. Each text gets 100 samples by improved consistent weighted sampling: a sample is the shingle with
   the smallest ``c / (y e^r)``, where ``ln y = r (floor(ln w / r + beta) - beta)`` and r, c and beta come from
   tables indexed by a hash of the shingle. Two texts agree on a sample with a probability equal to
   their similarity. Samples are banded, five to a band: at 0.8 at least one band of 20 agrees with
   probability 0.9996. Samples weigh shingles below 1 / 2**17 of all pairs like unique ones. With
   400 shingles to a document and up to 10**8 documents that raises a weight by half at most, so that a pair at
   0.8 samples like one of 0.72 at the worst, which a band finds with probability 0.98.
3. Exact copies fold into one text. Texts that agree on a band belong to one candidate cluster.
4. Exact weighted similarities are computed between all texts of a cluster, in blocks of bounded
   size. A cluster of more than one block is first compared within its blocks and with its most
   central text; only if that leaves it in several classes are its pairs of blocks compared as well.
   Tasks return the classes found, not the pairs. These similarities use every frequency exactly.

Defined results: null texts and texts without words are linked with nothing, not even each other.
Rows without ``doc_id`` are linked with nothing and have no class. Rows that share a ``doc_id`` are one
document. An empty table has no classes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.components import connected_components
from tallyframe.llm.staging import Workspace, columns_of, fresh
from tallyframe.llm.words import SHINGLE_BITS, list_array, mixed, shingle_counts, stream, word_chunks

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
SAMPLES = BANDS * ROWS

#: Shingles of so many documents share the highest idf.
LEAST = 2
#: Frequencies of at least 1 / HEAVY_SHARE of all (document, shingle) pairs are sent to every task.
HEAVY_SHARE = 1 << 17
#: A task counts so many shingles before it sends them, and adds up those of so many bytes of texts at once.
RUN, SLICE_BYTES = 1 << 19, 4 << 20
#: A task sends about so many counted shingles in one batch.
SENT = 1 << 17

BLOCK_DOCS, BLOCK_BYTES = 256, 16 << 20
_TABLE = 1 << 14
_ROWS_AT_ONCE = 4096
_COLUMNS_AT_ONCE = 1 << 13
_CLOSE = 1e-9


# --- document frequencies


class Weights:
    """Global weights of shingles: those whose frequencies are given, and 2 for all others."""

    def __init__(self, n_docs: int, least: int, ids: np.ndarray, frequencies: np.ndarray) -> None:
        order = np.argsort(ids)
        self.n_docs, self.least = n_docs, least
        self.ids, self.frequencies = ids[order].astype(np.uint64), frequencies[order]
        top = np.log(max(n_docs, 1) / least)
        idf = np.log(max(n_docs, 1) / np.maximum(self.frequencies, least)) if top > 0 else np.full(len(ids), top)
        self.factors = np.maximum(1.0, 1.0 + idf / top) if top > 0 else np.full(len(ids), 2.0)

    def extended(self, ids: np.ndarray, frequencies: np.ndarray) -> Weights:
        """The weights with more frequencies, of shingles that may be given several times."""
        ids, first = np.unique(np.concatenate((self.ids, ids.astype(np.uint64))), return_index=True)
        return Weights(self.n_docs, self.least, ids, np.concatenate((self.frequencies, frequencies))[first])

    def knows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which ids have a given frequency, and the places of these."""
        if not len(self.ids):
            return np.zeros(len(ids), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        known = self.ids[at] == ids
        return known, at[known]

    def of(self, ids: np.ndarray) -> np.ndarray:
        out = np.full(len(ids), 2.0)
        known, at = self.knows(ids)
        out[known] = self.factors[at]
        return out


def _planes(values: np.ndarray) -> bytes:
    """64-bit integers a byte plane after the other, so that their high bytes, mostly zeros, compress."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()


def _counted_runs(slices: int):
    """Arrow batches of texts to runs of shingles: range of ids, differences of the sorted ids, documents of each."""
    edges = np.ceil(np.arange(slices + 1) * (2.0**SHINGLE_BITS / slices)).astype(np.uint64)

    def run(found: list[np.ndarray]):
        """Batches of ranges of about SENT ids; ``found`` is emptied, so that its ids are held once."""
        ids = np.concatenate(found)
        found.clear()
        ids.sort()
        first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        counts = np.diff(np.append(first, len(ids))).astype(np.uint64)
        ids = ids[first]
        del first
        cuts = np.searchsorted(ids, edges)
        some = np.flatnonzero(np.diff(cuts))
        while len(some):
            n = max(1, int(np.searchsorted(cuts[some + 1], cuts[some[0]] + SENT, "right")))
            parts = [slice(cuts[k], cuts[k + 1]) for k in some[:n]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some[:n], pa.int64()),
                    pa.array([_planes(np.diff(ids[p], prepend=np.uint64(0))) for p in parts], pa.binary()),
                    pa.array([_planes(counts[p]) for p in parts], pa.binary()),
                ],
                ["slice", "steps", "counts"],
            )
            some = some[n:]

    def count(batches):
        found, held = [], 0
        for batch in batches:
            for words in word_chunks(batch.column(0)):
                _, ids, _ = shingle_counts(words, SHINGLE_WORDS)
                found.append(ids)
                held += len(ids)
                if held >= RUN:
                    yield from run(found)
                    held = 0
        if held:
            yield from run(found)

    return count


def _added_runs(runs: pa.Table) -> pa.Table:
    """Frequencies above LEAST of one range of ids; the row without id holds the sum of all frequencies."""
    ids = np.concatenate([np.cumsum(_values(r)) for r in runs["steps"].to_pylist()])
    counts = np.concatenate([_values(r) for r in runs["counts"].to_pylist()]).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    total = np.add.reduceat(counts[order], first)
    kept = total > LEAST
    named = pa.array(ids[first[kept]].astype(np.int64))
    return pa.table(
        {
            "id": pa.concat_arrays([pa.nulls(1, pa.int64()), named]),
            "n": pa.array(np.concatenate(([total.sum()], total[kept])), pa.int64()),
        }
    )


def shingle_weights(work: Workspace, texts: DataFrame) -> tuple[Weights, DataFrame, bool]:
    """Weights from the document frequencies of all rows; ``texts`` has the text as its only column.

    Besides the weights that every task gets: a table (id, n) of the other frequencies above LEAST, and whether
    there can be any.
    """
    n_docs, n_bytes = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()
    runs = texts.mapInArrow(_counted_runs(max(1, -(-n_bytes // SLICE_BYTES))), "slice bigint, steps binary, counts binary")
    counted = work.keep(runs.groupBy("slice").applyInArrow(_added_runs, "id bigint, n bigint"))
    n_pairs = counted.where("id IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = max(LEAST, -(-n_pairs // HEAVY_SHARE))
    named = counted.where("id IS NOT NULL")
    frequent = named.where(F.col("n") >= heavy).toPandas()  # at most HEAVY_SHARE rows
    weights = Weights(n_docs, LEAST, frequent["id"].to_numpy(np.uint64), frequent["n"].to_numpy(np.float64))
    return weights, named.where(F.col("n") < heavy), heavy > LEAST + 1


def unsent(weights):
    """Column function: the shingles of a text whose frequencies ``weights``, a broadcast, does not have."""

    @F.arrow_udf("array<bigint>")
    def ids_of(texts: pa.Array) -> pa.Array:
        parts = []
        for words in word_chunks(texts):
            bounds, ids, _ = shingle_counts(words, SHINGLE_WORDS)
            known, _ = weights.value.knows(ids)
            bounds = np.concatenate(([0], np.cumsum(~known)))[bounds]
            parts.append(list_array(bounds, pa.array(ids[~known].astype(np.int64))))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return ids_of


def with_frequencies(work: Workspace, texts: DataFrame, weights, others: DataFrame, any_: bool) -> DataFrame:
    """The texts with ``seen_ids`` and ``seen_counts``, their shingles in ``others`` and the frequencies of these.

    A shingle of ``others`` is in fewer than 1 / HEAVY_SHARE of all pairs, so that no key of the join is hot.
    """
    if not any_:
        none = F.lit(None).cast("array<bigint>")
        return texts.select("*", none.alias("seen_ids"), none.alias("seen_counts"))
    # Texts that share a key would share their frequencies, which are the same for all.
    key = F.xxhash64("node", "text_md5")
    wanted = texts.select(key.alias("of"), F.explode(unsent(weights)("text")).alias("id"))
    seen = wanted.join(others, "id").groupBy("of").agg(F.collect_list(F.struct("id", "n")).alias("seen"))
    seen = seen.select("of", F.col("seen.id").alias("seen_ids"), F.col("seen.n").alias("seen_counts"))
    frame = work.keep(texts.withColumn("of", key).join(seen, "of", "left").drop("of"))
    work.drop(texts)
    return frame


# --- signatures


@lru_cache(maxsize=1)
def _sampling_tables():
    """r, 1 / r, ln c and beta for a shingle's table row and each sample; scores and steps of the plain weight 2."""

    def uniform(i: int) -> np.ndarray:
        return ((stream(10 + i, _TABLE * SAMPLES) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53

    def narrow(t: np.ndarray) -> np.ndarray:
        return t.reshape(_TABLE, SAMPLES).astype(np.float32)

    # One wide array after the other: a worker keeps what it once took.
    r = -np.log(uniform(0) * uniform(1))
    tables = [narrow(r), narrow(1 / r)]
    del r
    tables += [narrow(np.log(-np.log(uniform(2) * uniform(3)))), narrow(uniform(4))]
    score, step = _sample(tables, slice(None), np.full(_TABLE, np.log(2.0), np.float32))
    return tables, score, step


def _sample(tables, rows: np.ndarray | slice, log_weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r, inverse, log_c, beta = (t[rows] for t in tables)
    step = np.floor(log_weight[:, None] * inverse + beta)
    return log_c - r * (step - beta) - r, step.astype(np.int32)


def samples(bounds: np.ndarray, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A row of SAMPLES 64-bit samples for each document; documents without shingles get zeros."""
    tables, plain_score, plain_step = _sampling_tables()
    rows = (mixed(ids ^ np.uint64(1 << 60)) % np.uint64(_TABLE)).astype(np.int64)
    log_weight = np.log(weights).astype(np.float32)
    plain = weights == 2.0
    every = np.arange(SAMPLES)
    out = np.zeros((len(bounds) - 1, SAMPLES), np.uint64)
    for d in range(len(bounds) - 1):
        best = None
        for low in range(bounds[d], bounds[d + 1], _ROWS_AT_ONCE):
            high = min(low + _ROWS_AT_ONCE, bounds[d + 1])
            here = rows[low:high]
            score = plain_score.take(here, axis=0)
            other = np.flatnonzero(~plain[low:high])
            if len(other):
                score[other], other_step = _sample(tables, here[other], log_weight[low:high][other])
            arg = score.argmin(0)
            value = score[arg, every]
            step = plain_step[here[arg], every]
            if len(other):
                place = np.full(high - low, -1)
                place[other] = np.arange(len(other))
                own = place[arg]
                step = np.where(own >= 0, other_step[np.maximum(own, 0), every], step)
            key = ids[low:high][arg] ^ (step.astype(np.int64).astype(np.uint64) << np.uint64(SHINGLE_BITS))
            if best is None:
                best, out[d] = value, key
            else:
                better = value < best
                out[d][better], best = key[better], np.minimum(value, best)
    return mixed(out)


def band_keys(bounds: np.ndarray, sampled: np.ndarray) -> pa.ListArray:
    """The bands of each document as 64-bit keys; none for documents without shingles."""
    has = np.diff(bounds) > 0
    place = stream(30, ROWS) | np.uint64(1)
    folded = (sampled.reshape(-1, BANDS, ROWS) * place).sum(2, dtype=np.uint64) + stream(31, BANDS)
    keys = mixed(folded)[has].reshape(-1).view(np.int64)
    return list_array(np.concatenate(([0], np.cumsum(has * BANDS))), pa.array(keys))


def banded(weights):
    """Column function: the band keys of a text; ``weights`` is a broadcast of Weights."""

    @F.arrow_udf("array<bigint>")
    def bands(texts: pa.Array) -> pa.Array:
        parts = []
        for words in word_chunks(texts):
            bounds, ids, counts = shingle_counts(words, SHINGLE_WORDS)
            weight = weights.value.of(ids) * counts
            parts.append(band_keys(bounds, samples(bounds, ids, weight)))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return bands


# --- exact similarities


class Elements:
    """Weighted shingles of texts as sets: the k-th occurrence of a shingle is an element of its weight."""

    def __init__(self, texts: pa.Array, weights: Weights) -> None:
        self.keys: list[np.ndarray] = []
        self.worth: list[np.ndarray] = []
        for words in word_chunks(texts):
            bounds, ids, counts = shingle_counts(words, SHINGLE_WORDS)
            worth = weights.of(ids)
            more = np.concatenate(([0], np.cumsum(counts)))
            nth = np.arange(more[-1]) - np.repeat(more[:-1], counts)
            keys = np.repeat(ids, counts)
            keys = np.where(nth == 0, keys, mixed(keys + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            worth = np.repeat(worth, counts)
            for d in range(words.n_docs):
                own = slice(more[bounds[d]], more[bounds[d + 1]])
                self.keys.append(keys[own])
                self.worth.append(worth[own])

    def similarities(self, which: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of every two of the texts."""
        size = np.array([self.worth[i].sum() for i in which])
        keys = np.concatenate([self.keys[i] for i in which])
        worth = np.concatenate([self.worth[i] for i in which])
        owner = np.repeat(np.arange(len(which)), [len(self.keys[i]) for i in which])
        order = np.argsort(keys)
        in_order = keys[order]
        new = np.concatenate(([True], in_order[1:] != in_order[:-1])) if len(keys) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        shared = np.bincount(group)[group] > 1 if len(keys) else new
        order = order[shared]
        column = np.cumsum(new[shared]) - 1 if len(order) else order
        common = np.zeros((len(which), len(which)))
        # The intersection is a product of matrices with a column for each element that texts share.
        cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + _COLUMNS_AT_ONCE, _COLUMNS_AT_ONCE))
        for low, high in zip(cuts[:-1], cuts[1:]):
            if low == high:
                continue
            at = column[low:high] - column[low]
            has = np.zeros((len(which), int(at[-1]) + 1))
            has[owner[order[low:high]], at] = np.sqrt(worth[order[low:high]])
            common += has @ has.T
        return common / np.maximum(size[:, None] + size[None, :] - common, _CLOSE)


def class_links(nodes: np.ndarray, clusters: np.ndarray, elements: Elements, similarity: float) -> list[tuple[int, int]]:
    """Links that join, within each cluster, the texts that similar pairs connect."""
    out = []
    order = np.argsort(clusters, kind="stable")
    for which in np.split(order, np.flatnonzero(np.diff(clusters[order])) + 1):
        if len(which) < 2:
            continue
        similar = elements.similarities(which) >= similarity - _CLOSE
        rest = set(range(len(which)))
        while rest:
            root = rest.pop()
            fringe = [root]
            while fringe:
                near = rest.intersection(np.flatnonzero(similar[fringe.pop()]).tolist())
                rest -= near
                fringe += near
                out += [(int(nodes[which[root]]), int(nodes[which[k]])) for k in near]
    return out


def _compared(rows: DataFrame, keys: list[str], weights, similarity: float) -> DataFrame:
    """Links within the clusters of each group of ``keys``; rows have node, cluster, text, seen_ids and seen_counts."""

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ids, counts = (np.concatenate([np.zeros(0, np.int64), *group[c].dropna()]) for c in ("seen_ids", "seen_counts"))
        known = weights.value.extended(ids, counts.astype(np.float64))
        elements = Elements(pa.array(group["text"], pa.string()), known)
        links = class_links(group["node"].to_numpy(), group["cluster"].to_numpy(), elements, similarity)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return rows.select("node", "cluster", "text", "seen_ids", "seen_counts", *keys).groupBy(*keys).applyInPandas(compare, "a bigint, b bigint")


def text_classes(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Two tables: a row per document (doc_id, text_md5, comparable) and one per comparable text (text_md5, node, class).

    ``node`` is the smallest doc_id that has the text, ``class`` the smallest of its class. Documents
    without id or words are not comparable.
    """
    work = Workspace(docs.sparkSession, "minhash")
    sent, others, any_ = shingle_weights(work, docs.select("text"))
    weights = work.spark.sparkContext.broadcast(sent)
    signed = work.keep(
        docs.select(
            "doc_id",
            F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
            F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("bytes"),
            banded(weights)("text").alias("bands"),
        )
    )
    texts = work.keep(
        signed.where(F.col("doc_id").isNotNull() & (F.size("bands") > 0))
        .groupBy("text_md5")
        .agg(F.min("doc_id").alias("node"), F.first("bytes").alias("bytes"), F.first("bands").alias("bands"))
    )
    members = texts.select("node", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = work.keep(members.join(buckets.where("head != last"), "bucket").select("bucket", "node", "head", "n"))
    clusters = connected_components(work, shared.select("node", "head"))
    central = shared.groupBy("node").agg(F.sum("n").alias("met"))
    placed = (
        clusters.join(central, "node")
        .join(texts.groupBy("node").agg(F.max("bytes").alias("bytes")), "node")
        .select("node", F.col("component").alias("cluster"), "met", "bytes")
    )
    measured = placed.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum("bytes").alias("volume"),
        F.max_by("node", F.struct("met", F.col("node"))).alias("pilot"),
    )
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_DOCS), F.ceil(F.col("volume") / BLOCK_BYTES)).cast("bigint")
    measured = work.keep(measured.withColumn("blocks", blocks))
    small = F.col("blocks") == 1
    n_texts, n_bytes = measured.where(small).agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("size", "volume")]).first()
    n_packs = max(1, -(-n_texts // BLOCK_DOCS), -(-n_bytes // BLOCK_BYTES))
    # A small cluster goes to a pack of many; a large one has blocks of its own, each with its pilot.
    assigned = placed.join(measured, "cluster").select(
        "node",
        "cluster",
        "pilot",
        "blocks",
        F.when(small, F.pmod(F.xxhash64("cluster"), F.lit(n_packs))).otherwise(F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("block"),
    )
    source = docs.select(F.col("doc_id").alias("node"), "text", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))
    stored = work.keep(assigned.join(source, "node").dropDuplicates(["node", "text_md5"]))
    stored = with_frequencies(work, stored, weights, others, any_)
    home = F.when(small, F.lit(-1)).otherwise(F.col("cluster"))
    every_block = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    at = F.when(~small & (F.col("node") == F.col("pilot")), every_block).otherwise(F.array("block"))
    first = stored.withColumn("home", home).withColumn("block", F.explode(at))
    links = work.keep(_compared(first, ["home", "block"], weights, similarity))
    classes = connected_components(work, links)

    large = stored.where(~small)
    if not large.isEmpty():
        labelled = large.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component")
        # Written, so that Spark knows how small it is: the texts need not move to join it.
        open_ = work.keep(
            labelled.groupBy("cluster").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high").select("cluster")
        )
        labelled = labelled.join(open_, "cluster", "left_semi")
        pairs = F.transform(
            every_block,
            lambda other: F.struct(
                F.least(F.col("block"), other).alias("low"), F.greatest(F.col("block"), other).alias("high")
            ),
        )
        dealt = labelled.withColumn("pair", F.explode(F.filter(pairs, lambda p: p["low"] != p["high"]))).withColumn("home", F.col("cluster"))
        more = work.keep(_compared(dealt, ["pair", "home"], weights, similarity))
        if not more.isEmpty():
            classes = connected_components(work, links.unionByName(more))
    work.drop(shared)

    named = texts.select("text_md5", "node").join(classes, "node", "left")
    named = named.select("text_md5", "node", F.coalesce("component", "node").alias("class"))
    comparable = F.col("doc_id").isNotNull() & (F.size("bands") > 0)
    return signed.select("doc_id", "text_md5", comparable.alias("comparable")), named


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_md5, class_id (the smallest doc_id of the class), kept (doc_id = class_id), a row for each row."""
    signed, named = text_classes(docs, similarity)
    named = named.select(F.col("text_md5").alias("of"), F.col("class"))
    result = signed.join(named, (F.col("text_md5") == F.col("of")) & F.col("comparable"), "left")
    class_id = F.coalesce("class", "doc_id")
    return result.select(
        "doc_id", "text_md5", class_id.alias("class_id"), F.coalesce(F.col("doc_id") == class_id, F.lit(True)).alias("kept")
    )


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents with one of each class, that of the smallest id; of repeated rows, one stays."""
    id_, md5 = fresh(docs, "kept_id", "kept_md5")
    (own,) = fresh(docs, "own_md5")
    signed, named = text_classes(docs, similarity)
    # A document stays if it has the smallest id of its class, which is a row of the texts.
    chosen = named.where("class = node").select(F.col("node").alias(id_), F.col("text_md5").alias(md5))
    alone = signed.where("NOT comparable").select(F.col("doc_id").alias(id_), F.col("text_md5").alias(md5))
    keys = chosen.unionByName(alone)
    marked = docs.withColumn(own, F.md5(F.coalesce("text", F.lit(""))))
    matched = marked.join(keys, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(md5)), "left_semi")
    with_id = matched.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", own])
    return with_id.unionByName(matched.where(F.col("doc_id").isNull())).select(*columns_of(docs))
