"""Mixing sources to target weights by balanced sampling with the cube method.

Each source has a target: its share, by weight, of all words, at most ``max_copies`` times its own;
what a source cannot take is shared among the others by weight. A document of a source with target
``t`` and size ``s`` is to be taken ``t / s`` times on average: the whole part of that surely, and the rest
with that inclusion probability.

The cube method decides the fractions. A move of the undecided documents of a block changes their probabilities along
a vector that leaves both their sum (documents) and the sum of probability times size (words) as they are:
a vector of the null space of those two constraints. It goes in either direction, with the odds that keep each
probability's mean, until one of them is 0 or 1 and that document decided. At most two documents of
a block stay undecided. The undecided of all blocks of a source form the next, about 500 times smaller, round
of blocks; once a source fits one block, its last two documents are landed on the nearest of the four outcomes.

Blocks are dealt by a hash of the id and the text, rows that repeat often by a running number too, and have about ``BLOCK``
rows, however many documents
a source has. A block decides its longest documents first, so that the undecided ones are short and a source lands near its
target. Random choices come from hashes, so that reruns agree.

Defined results: a null text has size 0; documents of size 0 are taken like any other, as 0 words;
rows with the same id are documents of their own; a source of size 0 has target 0; an empty table
gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.staging import Workspace
from tallyframe.llm.words import stream

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
BLOCK = 1000
_CLOSE = 1e-9


def word_count(text: Column) -> Column:
    """The number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, n_docs, source_size and target of each source; ``sizes`` has ``source`` and ``size``.

    The windows below run over one row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    everything = Window.partitionBy()
    rows = (
        sources.withColumn("place", place)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("most", (F.col("source_size") * max_copies).cast("double"))
        .withColumn("full_at", F.col("most") / F.col("weight"))
    )
    # Sources fill up in the order of full_at as the words per unit of weight rise; the level is what
    # the words left by the full ones give to the weights of the others.
    order = Window.orderBy("full_at", "place")
    left = F.sum("most").over(everything) / max_copies - F.coalesce(
        F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    open_weight = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "place", "level"))).over(everything)["level"]
    return (
        rows.withColumn("level", left / open_weight)
        .withColumn("level", level)
        .select(
            "source",
            "n_docs",
            "source_size",
            F.least(F.col("most"), F.col("level") * F.col("weight")).alias("target"),
        )
    )


def move(chance: list[float], size: list[float], draws: list[float]) -> list[float]:
    """The flight of a block: probabilities after moves through the null space, at most two of them undecided.

    Each move takes the longest undecided document one way and all other undecided ones the other, those nearer to a
    half by more, so that documents and words stay as they are. A long document is so decided while the many
    short ones can still make up for it.
    """
    chance, size = np.array(chance, np.float64), np.array(size, np.float64)
    chance[chance <= _CLOSE], chance[chance >= 1 - _CLOSE] = 0.0, 1.0
    chosen = iter(draws)  # every move decides a document, so there is a draw for each
    left = np.argsort(-size, kind="stable")
    while True:
        left = left[(chance[left] > 0) & (chance[left] < 1)]
        if len(left) < 2:
            return chance.tolist()
        moving, along = left, _balanced(chance[left], size[left])
        if along is None and len(left) > 2:
            # The others are all as long as each other, and so can move among themselves.
            moving, along = left[1:], _balanced(chance[left[1:]], size[left[1:]])
        if along is None:
            return chance.tolist()
        here = chance[moving]
        with np.errstate(divide="ignore", invalid="ignore"):
            up, down = (1 - here) / np.abs(along), here / np.abs(along)
        ahead = np.where(along > 0, up, np.where(along < 0, down, np.inf)).min()
        back = np.where(along > 0, down, np.where(along < 0, up, np.inf)).min()
        step = ahead if next(chosen) * (ahead + back) < back else -back
        moved = here + step * along
        moved[moved < _CLOSE], moved[moved > 1 - _CLOSE] = 0.0, 1.0
        chance[moving] = moved


def _balanced(chance: np.ndarray, size: np.ndarray) -> np.ndarray | None:
    """A direction that raises the first probability and keeps their sum and the sum of the words; None if there is none."""
    room = chance * (1 - chance)
    room[0] = 0.0
    total, words = room.sum(), (room * size).sum()
    # Sizes from their mean, so that equal ones are told by a zero.
    off = size - words / total
    varied = (room * off * off).sum()
    if varied <= _CLOSE * max(1.0, words / total) ** 2 * total:
        if abs(off[0]) > _CLOSE * max(1.0, size[0]):
            return None
        along = -room / total
    elif len(chance) < 3:
        return None
    else:
        along = -room * (1 / total + off * off[0] / varied)
    along[0] = 1.0
    # The least part of a move that counts; smaller ones are rounding.
    along[np.abs(along) < 1e-12] = 0.0
    return along


def land(chance: list[float], size: list[float]) -> list[float]:
    """The few undecided documents rounded to the outcome nearest in words, then in documents, then the first."""
    chance = list(chance)
    rest = [k for k, x in enumerate(chance) if 0 < x < 1]
    words = sum(chance[k] * size[k] for k in rest)
    docs = sum(chance[k] for k in rest)

    def miss(outcome: int) -> tuple[float, float, int]:
        taken = [k for i, k in enumerate(rest) if outcome >> i & 1]
        return abs(sum(size[k] for k in taken) - words), abs(len(taken) - docs), outcome

    best = min(range(1 << len(rest)), key=miss)
    for i, k in enumerate(rest):
        chance[k] = float(best >> i & 1)
    return chance


def _round(rows: DataFrame, salt: int, last: bool) -> DataFrame:
    """Decide all but two documents of each block, or, in the last round, all of them."""

    def decide(block: pd.DataFrame) -> pd.DataFrame:
        # The longest first: the two documents that stay undecided are then the shortest.
        block = block.sort_values(["size", "order", "doc_id"], ascending=[False, True, True], kind="stable", ignore_index=True)
        seed = int(block["order"].min()) & 0xFFFFFFFF
        draws = (stream(seed * 64 + salt, len(block)) >> np.uint64(11)).astype(np.float64) / 2.0**53
        chance = move(block["chance"].tolist(), block["size"].astype(float).tolist(), draws.tolist())
        if last:
            chance = land(chance, block["size"].astype(float).tolist())
        return block.assign(chance=chance)

    blocks = F.greatest(F.ceil(F.col("n_docs") / BLOCK), F.lit(1))
    dealt = rows.withColumn("block", F.lit(0).cast("bigint") if last else F.pmod(F.xxhash64("order", "spread", F.lit(salt)), blocks))
    return dealt.groupBy("source", "block").applyInPandas(decide, dealt.schema).drop("block")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies and taken = copies * size."""
    work = Workspace(docs.sparkSession, "mix")
    order = F.xxhash64("doc_id", "text")
    sizes = work.keep(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), order.alias("order")))
    # Rows that repeat are alike, so it does not matter which of them go to which block.
    often = work.keep(
        sizes.groupBy(F.col("order").alias("alike")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK / 10)
    )
    spread = F.when(F.col("n").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.ceil(F.col("n") * 10 / BLOCK))).otherwise(F.lit(0))
    sizes = work.keep(
        sizes.join(often, F.col("order") == F.col("alike"), "left").select("doc_id", "source", "size", "order", spread.cast("bigint").alias("spread"))
    )
    targets = source_targets(sizes, weights, max_copies)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # A share that is a whole number up to rounding leaves nothing to chance.
    whole = F.floor(share + _CLOSE)
    rows = sizes.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "inner").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        whole.cast("bigint").alias("whole"),
        F.greatest(share - whole, F.lit(0.0)).alias("chance"),
        "order",
        "spread",
        "n_docs",
    )
    decided = []
    for salt in range(64):
        largest = rows.agg(F.coalesce(F.max("n_docs"), F.lit(0))).first()[0]
        last = largest <= BLOCK
        rows = work.keep(_round(rows, salt, last))
        undecided = (F.col("chance") > 0) & (F.col("chance") < 1)
        if last:
            decided.append(rows)
            break
        decided.append(rows.where(~undecided))
        rows = rows.where(undecided)
        left = rows.groupBy("source").agg(F.count(F.lit(1)).alias("left"))
        rows = (
            rows.drop("n_docs")
            .join(left.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
            .withColumn("n_docs", F.col("left"))
            .drop("of", "left")
        )
    every = decided[0]
    for more in decided[1:]:
        every = every.unionByName(more)
    copies = (F.col("whole") + F.col("chance")).cast("bigint")
    return every.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
