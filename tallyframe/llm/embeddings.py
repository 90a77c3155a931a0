"""Near-duplicate embeddings: random-hyperplane hashing, exact cosines, connected components.

Vectors are compared only with vectors of the same label and length. Each gets a sign pattern per table,
a bit for the side of each of the table's random hyperplanes. Two vectors at the threshold agree on a
bit with probability 1 - arccos(threshold) / pi; tables of so many bits that a label's vectors spread
over buckets of about ``BUCKET``, and so many tables that the chance to meet in none is below ``MISS``.

Vectors of a bucket are compared with each other in double precision inside the task. A bucket of
more than ``BLOCK`` vectors is cut into blocks, and each pair of blocks is a task of its own. A pair that
meets in several tables counts in the first. What leaves a task are sums of links per vector and the
links that join each connected group, never the pairs.

Equal vectors of a label fold into one that counts as many times.

Defined results: a vector that is null, zero, empty, or holds a null or a non-finite number, and a vector
without label, links with nothing and is its own component. Rows with the same vec_id are vectors of
their own. A component's id is its smallest vec_id that is not null. An empty table has no components.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.components import connected_components
from tallyframe.llm.staging import Workspace
from tallyframe.llm.words import stream

THRESHOLD = 0.93
BUCKET = 256
BLOCK = 1024
MISS = 1e-4
MAX_BITS = 24


def tables_for(bits: int, threshold: float) -> int:
    """So many tables of ``bits`` hyperplanes that a pair at the threshold meets in one, but for MISS."""
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if meet >= 1 else max(1, math.ceil(math.log(MISS) / math.log(1 - meet)))


@lru_cache(maxsize=8)
def _hyperplanes(length: int, count: int) -> np.ndarray:
    u, v = (
        ((stream(seed, length * count) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53 for seed in (50, 51)
    )
    return (np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)).reshape(length, count)


def sign_patterns(vectors: np.ndarray, bits: int, n_tables: int) -> np.ndarray:
    """An integer of ``bits`` bits for each vector and table."""
    sides = (vectors @ _hyperplanes(vectors.shape[1], bits * n_tables)) >= 0
    return (sides.reshape(len(vectors), n_tables, bits) * (1 << np.arange(bits))).sum(2)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, in double precision, whatever their magnitude."""
    vectors = np.asarray(vectors, np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _patterns(threshold: float):
    @F.arrow_udf("array<int>")
    def patterns(vectors: pa.Array, bits: pa.Array) -> pa.Array:
        lengths = np.asarray(pa.compute.list_value_length(vectors))
        kinds = np.asarray(bits)
        out: list = [None] * len(vectors)
        for length, kind in sorted(set(zip(lengths.tolist(), kinds.tolist()))):
            rows = np.flatnonzero((lengths == length) & (kinds == kind))
            for part in np.array_split(rows, -(-len(rows) // 2048)):
                values = np.asarray(vectors.take(pa.array(part)).flatten(), np.float64).reshape(len(part), length)
                found = sign_patterns(unit(values), kind, tables_for(kind, threshold)).astype(np.int32)
                for k, row in zip(part.tolist(), found):
                    out[k] = row
        return pa.array(out, pa.list_(pa.int32()))

    return patterns


def block_links(left: pd.DataFrame, right: pd.DataFrame | None, table: int, threshold: float) -> pd.DataFrame:
    """Sums of links per vector (b null) and links that join the connected ones, within a block or between two."""
    same = right is None
    right = left if same else right
    close = unit(np.stack(left["embedding"])) @ unit(np.stack(right["embedding"])).T >= threshold
    if same:
        np.fill_diagonal(close, False)
    a, b = left["node"].to_numpy(), right["node"].to_numpy()
    joined = spanning(close, a, b)
    patterns, others = np.stack(left["patterns"]), np.stack(right["patterns"])
    for t in range(table):
        close &= patterns[:, t][:, None] != others[:, t][None, :]
    sums = [(a, close @ right["n"].to_numpy())] + ([] if same else [(b, left["n"].to_numpy() @ close)])
    counted = [(node, None, int(n)) for nodes, ns in sums for node, n in zip(nodes, ns) if n]
    return found_rows(counted + [(x, y, 0) for x, y in joined])


def found_rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["a", "b", "links"], dtype=object).astype({"links": "int64"})


def spanning(close: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[str, str]]:
    """A spanning forest of the links: a walk from each vector not reached yet."""
    out, rows, columns = [], set(range(len(a))), set(range(len(b)))
    while rows:
        fringe = [(rows.pop(), True)]
        root = a[fringe[0][0]]
        while fringe:
            k, is_row = fringe.pop()
            near = (columns if is_row else rows).intersection(np.flatnonzero(close[k] if is_row else close[:, k]).tolist())
            if is_row:
                columns -= near
            else:
                rows -= near
            out += [(root, (b if is_row else a)[j]) for j in near]
            fringe += [(j, not is_row) for j in near]
    return [(x, y) for x, y in out if x != y]


def linked(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept; ``vectors`` has vec_id, embedding and label."""
    work = Workspace(vectors.sparkSession, "embeddings")
    size = F.size("embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = F.col("label").isNotNull() & F.col("embedding").isNotNull() & (size > 0) & finite & F.exists("embedding", lambda x: x != 0)
    text = F.concat_ws("|", F.col("label").cast("string"), F.to_json("embedding"))
    named = vectors.select(
        "vec_id", "label", "embedding", F.when(F.coalesce(valid, F.lit(False)), F.md5(text)).alias("node")
    )
    single = work.keep(
        named.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("vec_id").alias("least"),
            F.count(F.lit(1)).alias("n"),
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
        )
        .withColumn("length", F.size("embedding"))
    )
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("of") / BUCKET)), F.lit(1)), F.lit(MAX_BITS)).cast("int")
    sizes = single.groupBy("label", "length").agg(F.count(F.lit(1)).alias("of")).select("label", "length", bits.alias("bits"))
    signed = work.keep(
        single.join(sizes, ["label", "length"]).select(
            "node", "n", "label", "embedding", "length", _patterns(threshold)("embedding", "bits").alias("patterns")
        )
    )
    bucket = ["label", "length", "table", "pattern"]
    dealt = signed.select("*", F.posexplode("patterns").alias("table", "pattern"))
    full = (
        signed.select("label", "length", F.posexplode("patterns").alias("table", "pattern"))
        .groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("of"))
        .where(F.col("of") > BLOCK)
        .withColumn("blocks", F.ceil(F.col("of") / BLOCK).cast("int"))
        .drop("of")
    )
    own = F.pmod(F.xxhash64("node", "table"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("own", k).alias("low"), F.greatest("own", k).alias("high")),
    )
    dealt = (
        dealt.join(full, bucket, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("pair", F.explode(pairs))
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        pair, table = group["pair"].iloc[0], int(group["table"].iloc[0])
        if pair["low"] == pair["high"]:
            return block_links(group, None, table, threshold)
        left, right = (group[group["own"] == pair[k]] for k in ("low", "high"))
        return block_links(left, right, table, threshold) if len(left) and len(right) else found_rows([])

    found = work.keep(
        dealt.select(*bucket, "pair", "own", "node", "n", "embedding", "patterns")
        .groupBy(*bucket, "pair")
        .applyInPandas(compare, "a string, b string, links bigint")
    )
    work.drop(signed)
    components = connected_components(work, found.where("b IS NOT NULL").select("a", "b"))
    sums = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    nodes = (
        single.select("node", "n", "least")
        .join(components, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(sums.withColumnRenamed("a", "node"), "node", "left")
    )
    smallest = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    per_node = nodes.join(smallest, "component").select(
        F.col("node").alias("of"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component_id"
    )
    component_id = F.when(F.col("of").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        named.select("vec_id", "node")
        .join(per_node, F.col("node") == F.col("of"), "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
            component_id.alias("component_id"),
            F.coalesce(F.col("vec_id") == component_id, F.lit(False)).alias("kept"),
        )
    )
