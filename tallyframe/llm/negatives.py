"""Hard negatives for anchors: exact integer inner products by the Four-Russians method.

Components become integers, ``floor(scale * x)``. Every vector is written as bit planes: for each bit of its
components in two's complement and each group of eight dimensions a byte that packs that bit of the eight. For an
anchor, a table per group holds the sums of all 256 subsets of its eight components. The inner product of anchor
and candidate is then looked up: the tables' entries at the candidate's bytes, added over the groups and shifted by the
plane, the sign plane subtracted. These are the full exact scores, not estimates.

Anchors in blocks of ``ANCHORS`` meet candidates in blocks of ``STRIPE`` at most, each meeting a group of its own; rows are
dealt to blocks by a hash of a running number, so that no label or repeated id makes a block larger. Two rounds:

1. each anchor's positives, the ``n_positives`` best other rows of its label;
2. for every positive, the ``n_negatives`` best rows of another label whose score is at least ``low`` percent of the
   positive's and not above it.

A meeting returns its best rows per anchor (and positive) only, and forgets what cannot be among them as it goes
through the block; the best of all meetings are the result, since being among the best of all needs being among
the best of a block. Every anchor is scored against every row, so the work grows with both.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part. Higher scores
come first, ties by smaller vec_id, rows without vec_id last. Rows with the same vec_id are rows of their own. Only
vectors of equal length are compared; of two empty vectors the product is 0. Components beyond 2**25 / scale count as
that, so that sums stay exact in 64 bits up to 4,096 dimensions; longer vectors are refused. A label may be of any
type. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.staging import Workspace

SCALE, MOST_BITS, MOST_DIMENSIONS = 256, 26, 4096
N_POSITIVES, N_NEGATIVES, LOW = 5, 5, 80
ANCHORS, STRIPE, LEAST_STRIPE, STRIPES = 1 << 14, 1 << 16, 256, 24
#: Sizes inside a task: anchors whose tables are held, and candidates scored at once.
HELD, AT_ONCE = 64, 1024
_NO_ID = 2**63 - 1


def packed_planes(values: np.ndarray, bits: int) -> np.ndarray:
    """The bit planes of rows of integers: bytes by row, plane (lowest first) and group of eight dimensions."""
    n, length = values.shape
    groups = -(-length // 8)
    planes = np.empty((n, bits, groups), np.uint8)
    for k in range(bits):
        planes[:, k] = np.packbits((values >> k) & 1, axis=1, bitorder="little").reshape(n, groups)
    return planes


def unpacked(planes: np.ndarray) -> np.ndarray:
    """The integers that planes were packed from, filled with zeros to whole groups."""
    bits = planes.shape[1]
    weights = [1 << k for k in range(bits - 1)] + [-(1 << (bits - 1))]
    ones = np.unpackbits(planes, axis=2, bitorder="little")
    return sum(w * ones[:, k].astype(np.int64) for k, w in enumerate(weights))


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """For each group of eight dimensions and each byte the sums, by anchor, of the components at the byte's ones."""
    n, length = anchors.shape
    tables = np.zeros((length // 8, 256, n), np.int64)
    for d in range(8):
        tables[:, 1 << d : 2 << d] = tables[:, : 1 << d] + anchors[:, d::8].T[:, None, :]
    return tables


def looked_up(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """The inner products of candidates (rows) and anchors (columns)."""
    n, bits, groups = planes.shape
    index = planes.astype(np.intp)
    scores = np.zeros((n, tables.shape[2]), tables.dtype)
    part = np.empty_like(scores)
    for k in range(bits - 1, -1, -1):
        scores += scores
        for g in range(groups):
            np.take(tables[g], index[:, k, g], axis=0, out=part, mode="clip")
            if k == bits - 1:
                scores -= part
            else:
                scores += part
    return scores


class Best:
    """The best candidates found so far for each of some ranges of scores; a range belongs to an anchor."""

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int) -> None:
        self.low, self.high, self.most = low.copy(), high, most
        self.found = tuple(np.empty(0, np.int64) for _ in range(3))  # range, score, id

    def add(self, anchor: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Offer candidates (rows of ``scores``), where allowed, to the ranges, whose anchors are columns."""
        mine = scores[:, anchor]
        row, of = np.nonzero((mine >= self.low) & (mine <= self.high) & allowed[:, anchor])
        if not len(row):
            return
        offered = of, mine[row, of].astype(np.int64), ids[row]
        of, score, key = (np.concatenate(pair) for pair in zip(self.found, offered))
        order = np.lexsort((key, -score, of))
        of, score, key = of[order], score[order], key[order]
        start = np.searchsorted(of, of)
        rank = np.arange(len(of)) - start
        self.found = tuple(x[rank < self.most] for x in (of, score, key))
        full = rank == self.most - 1
        self.low[of[full]] = score[full]


def _meeting(table: pa.Table, bits: int, most: int, same_label: bool) -> pa.Table:
    """The best candidates of one meeting of an anchor block with a candidate block, by range of an anchor."""
    out = []
    lengths = np.asarray(table["length"])
    is_anchor = np.asarray(table["low"].is_valid())
    for length in np.unique(lengths):
        groups = -(-int(length) // 8)
        who, whom = (np.flatnonzero((lengths == length) & side) for side in (is_anchor, ~is_anchor))
        if not len(who) or not len(whom):
            continue
        anchors, candidates = table.take(pa.array(who)), table.take(pa.array(whom))
        planes = _planes(candidates["planes"], bits, groups)
        ids, rows = (np.asarray(candidates[c]) for c in ("key", "row"))
        labels, codes = _codes(anchors["label"], candidates["label"])
        own_rows = np.asarray(anchors["row"])
        if same_label:
            order = np.argsort(codes, kind="stable")
            planes, ids, rows, codes = planes[order], ids[order], rows[order], codes[order]
        by_label = np.argsort(labels, kind="stable")
        for start in range(0, len(by_label), HELD):
            held = by_label[start : start + HELD]
            for some in _of_one_label(held, labels) if same_label else [held]:
                mine = anchors.take(pa.array(some))
                tables = _smallest_type(subset_sums(unpacked(_planes(mine["planes"], bits, groups))), bits, groups)
                low, high = (mine[c].combine_chunks() for c in ("low", "high"))
                counts = low.value_lengths().to_numpy()
                anchor = np.repeat(np.arange(len(some)), counts)
                best = Best(low.flatten().to_numpy(), high.flatten().to_numpy(), most)
                first, last = 0, len(ids)
                if same_label:
                    first, last = np.searchsorted(codes, [labels[some[0]], labels[some[0]] + 1])
                for at in range(first, last, AT_ONCE):
                    part = slice(at, min(at + AT_ONCE, last))
                    alike = codes[part, None] == labels[some][None, :]
                    allowed = alike & (rows[part, None] != own_rows[some][None, :]) if same_label else ~alike
                    best.add(anchor, looked_up(tables, planes[part]), ids[part], allowed)
                of, score, key = best.found
                number = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
                out.append(
                    pa.table(
                        {"row": own_rows[some][anchor[of]], "number": number[of].astype(np.int32), "score": score, "key": key},
                        schema=_FOUND,
                    )
                )
    return pa.concat_tables(out) if out else _FOUND.empty_table()


_FOUND = pa.schema([("row", pa.int64()), ("number", pa.int32()), ("score", pa.int64()), ("key", pa.int64())])


def _of_one_label(held: np.ndarray, labels: np.ndarray) -> Iterator[np.ndarray]:
    cuts = np.flatnonzero(np.diff(labels[held])) + 1
    yield from np.split(held, cuts)


def _smallest_type(tables: np.ndarray, bits: int, groups: int) -> np.ndarray:
    """In 32 bits, which are faster, where no partial sum of the scores can leave them."""
    most = int(np.abs(tables).max(initial=0)) * groups << bits
    return tables.astype(np.int32) if most < 2**31 else tables


def _planes(column: pa.ChunkedArray, bits: int, groups: int) -> np.ndarray:
    said = b"".join(column.to_pylist())
    return np.frombuffer(said, np.uint8).reshape(len(column), bits, groups)


def _codes(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Integers that are equal where the values are, over all the columns."""
    codes = pa.concat_arrays([c for column in columns for c in column.chunks]).dictionary_encode().indices.to_numpy()
    return np.split(codes, np.cumsum([len(c) for c in columns])[:-1])


def _packing(bits: int):
    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        lengths = vectors.value_lengths().to_numpy()
        out: list = [None] * len(vectors)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            values = vectors.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), length)
            for row, planes in zip(rows.tolist(), packed_planes(values, bits)):
                out[row] = planes.tobytes()
        return pa.array(out, pa.binary())

    return pack


def _prepared(work: Workspace, vectors: DataFrame, is_anchor: Column, scale: int) -> tuple[DataFrame, int]:
    """The rows that take part, numbered and packed, and the number of bits of a component."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    edge = 1 << (MOST_BITS - 1)
    whole = F.transform(
        "embedding",
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(edge - 1.0)), F.lit(-1.0 * edge))).cast("bigint"),
    )
    rows = work.keep(
        vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))).select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce("vec_id", F.lit(_NO_ID)).cast("bigint").alias("key"),
            "label",
            F.size("embedding").alias("length"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
            whole.alias("whole"),
        )
    )
    reach = rows.agg(
        F.coalesce(F.max(F.array_max("whole")), F.lit(0)),
        F.coalesce(F.min(F.array_min("whole")), F.lit(0)),
        F.coalesce(F.max("length"), F.lit(0)),
    ).first()
    if reach[2] > MOST_DIMENSIONS:
        raise ValueError(f"vectors of more than {MOST_DIMENSIONS} dimensions")
    bits = max(int(reach[0]).bit_length(), (-int(reach[1]) - 1).bit_length() if reach[1] < 0 else 0) + 1
    packed = work.keep(rows.select("row", "key", "label", "length", "is_anchor", _packing(bits)("whole").alias("planes")))
    work.drop(rows)
    return packed, bits


def _best(rows: DataFrame, ranges: DataFrame, bits: int, most: int, same_label: bool, sizes: tuple[int, int]) -> DataFrame:
    """row (the anchor's), number (of its range, from 0), score and key of the best rows of each range, ranked from 1."""
    blocks, stripes = sizes

    def deal(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(name)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    no_range = F.lit(None).cast("array<bigint>")
    columns = ["row", "key", "label", "length", "planes", "low", "high"]
    candidates = rows.withColumns({"low": no_range, "high": no_range, "stripe": deal("stripe", stripes)})
    anchors = rows.where("is_anchor").join(ranges, "row").withColumn("block", deal("block", blocks))
    met = (
        candidates.select(*columns, "stripe", every(blocks).alias("block"))
        .unionByName(anchors.select(*columns, "block", every(stripes).alias("stripe")))
        .groupBy("block", "stripe")
        .applyInArrow(lambda t: _meeting(t, bits, most, same_label), "row bigint, number int, score bigint, key bigint")
    )
    first = Window.partitionBy("row", "number").orderBy(F.desc("score"), "key")
    return met.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = N_POSITIVES,
    n_negatives: int = N_NEGATIVES,
    low: int = LOW,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and label. ``is_anchor`` says which rows are anchors.
    """
    work = Workspace(vectors.sparkSession, "negatives")
    rows, bits = _prepared(work, vectors, is_anchor, scale)
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    stripe = min(STRIPE, max(LEAST_STRIPE, math.ceil(n / STRIPES)))
    sizes = max(1, math.ceil(n_anchors / ANCHORS)), max(1, math.ceil(n / stripe))

    def whole(value: int) -> Column:
        return F.array(F.lit(value).cast("bigint"))

    all_scores = rows.where("is_anchor").select("row", whole(-(2**62)).alias("low"), whole(2**62).alias("high"))
    positives = work.keep(_best(rows, all_scores, bits, n_positives, True, sizes).select("row", "score", "key"))
    # Positives of an anchor with equal scores share their range.
    highs = F.sort_array(F.collect_set("score"))
    ranges = (
        positives.groupBy("row")
        .agg(highs.alias("high"))
        .withColumn("low", F.transform("high", lambda p: F.ceil(p.cast("decimal(20,0)") * low / 100).cast("bigint")))
    )
    found = _best(rows, ranges, bits, n_negatives, False, sizes)
    named = ranges.select("row", F.posexplode("high").alias("number", "score"))
    of_positive = positives.join(named, ["row", "score"]).select(
        "row", "number", F.col("key").alias("positive"), F.col("score").alias("positive_score")
    )

    def named_id(key: str) -> Column:
        return F.nullif(F.col(key), F.lit(_NO_ID))

    anchor_ids = rows.where("is_anchor").select("row", named_id("key").alias("anchor_id"))
    return (
        found.select("row", "number", "rank", F.col("key").alias("negative"), F.col("score").alias("negative_score"))
        .join(of_positive, ["row", "number"])
        .join(anchor_ids, "row")
        .select(
            "anchor_id",
            named_id("positive").alias("positive_id"),
            "rank",
            named_id("negative").alias("negative_id"),
            "positive_score",
            "negative_score",
        )
    )
