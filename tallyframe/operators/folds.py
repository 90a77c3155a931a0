"""Stratified splits with exact class shares, decided by a hash of each row.

Within a class rows are taken in the order of a 62-bit hash of their values and a seed, so a rerun, another layout
of the files or another number of tasks gives the same parts. Where the cuts fall is found by narrowing:
counts of hash ranges by class, then of the ranges inside those that hold a cut. Each pass reads the rows once and
shuffles counts. Nothing is sorted; the driver sees one row per class and cut.

Rows of one hash, which are repeated rows, may stand on both sides of a cut. They are alike, so it does not matter which of
them go where, only how many: they are numbered by the task that reads them, after the rows of earlier tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions import ref
from tallyframe.sources.staging import run_folder, stage_parquet

KEY_BITS, DIGIT_BITS = 62, 16
#: A hash range of at most so many rows is counted hash by hash at once.
DIRECT_ROWS = 2**16


@dataclass(frozen=True)
class _Cut:
    """A cut of a class: the part before it ends after ``need`` of the ``rows`` rows whose hash starts with ``prefix``."""

    label: object
    number: int
    prefix: int
    shift: int
    rows: int
    need: int

    @property
    def first(self) -> int:
        return self.prefix << self.shift

    @property
    def end(self) -> int:
        """The first hash after the range."""
        return (self.prefix + 1) << self.shift

    @property
    def done(self) -> bool:
        return self.shift == 0 or self.need == self.rows

    @property
    def splits_equals(self) -> bool:
        return self.shift == 0 and self.need < self.rows


def row_hash(df: DataFrame, seed: int, columns: Sequence[str] | None = None) -> Column:
    """62 bits of a hash of the row's values (of ``columns`` only, if given) and the seed; where nulls are counts too."""
    used = [ref(c) for c in (df.columns if columns is None else columns)]
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.array(*[c.isNull() for c in used]), *used), 2)


def _is(column: str, value: object) -> Column:
    return ref(column).isNull() if value is None else ref(column) == F.lit(value)


def _narrowed(keys: DataFrame, open_cuts: Sequence[_Cut], shift: int) -> list[_Cut]:
    """The cuts of one class and range, or of all classes, in ranges of hashes that share all bits above ``shift``."""
    inside = None
    for cut in open_cuts:
        here = _is("label", cut.label) & (F.col("key") >= cut.first) & (F.col("key") < cut.end)
        inside = here if inside is None else inside | here
    first = F.lit(None).cast("bigint")
    for cut in open_cuts:
        first = F.when(_is("label", cut.label) & (F.col("key") >= cut.first) & (F.col("key") < cut.end), F.lit(cut.first)).otherwise(first)
    counted = (
        keys.where(inside)
        .groupBy("label", first.alias("first"), F.shiftright("key", shift).alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("label", "first").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = counted.withColumn("upto", F.sum("n").over(upto))
    holds = None
    for cut in open_cuts:
        here = _is("label", cut.label) & (F.col("first") == cut.first) & (F.col("upto") >= cut.need) & (F.col("upto") - F.col("n") < cut.need)
        holds = here if holds is None else holds | here
    out = []
    for row in ended.where(holds).collect():
        for cut in open_cuts:
            start = row["upto"] - row["n"]
            if (cut.label, cut.first) == (row["label"], row["first"]) and start < cut.need <= row["upto"]:
                out.append(_Cut(cut.label, cut.number, row["prefix"], shift, row["n"], cut.need - start))
    return out


def _cuts(keys: DataFrame, shares: Sequence[float]) -> list[_Cut]:
    sizes = {row["label"]: row["n"] for row in keys.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    cuts = []
    for label, n in sizes.items():
        for number in range(1, len(shares)):
            need = min(n, math.floor(n * math.fsum(shares[:number]) + 0.5))
            # A cut before all rows needs no search: no hash is below zero.
            cuts.append(_Cut(label, number, 0, KEY_BITS if need else 0, n, need))
    while open_cuts := [c for c in cuts if not c.done]:
        closed = [c for c in cuts if c.done]
        # Cuts of about the same range length are narrowed in one pass.
        shift = max(c.shift for c in open_cuts)
        now = [c for c in open_cuts if c.shift == shift]
        later = [c for c in open_cuts if c.shift != shift]
        finer = 0 if all(c.rows <= DIRECT_ROWS for c in now) else max(0, shift - DIGIT_BITS)
        cuts = closed + later + _narrowed(keys, now, finer)
    return cuts


def with_fold(
    df: DataFrame,
    label: str,
    shares: Sequence[float],
    seed: int = 0,
    columns: Sequence[str] | None = None,
    name: str = "fold",
) -> DataFrame:
    """``df`` with the number of the part of each row, from 0.

    Of the n rows of a class, parts 0 to k hold ``round(n * (shares[0] + ... + shares[k]))``, halves rounded up; the
    last part the rest. Rows without label are a class of their own. The frame is read several times, so stage
    it if it is costly. Classes are few: each has its cuts on the driver and in the plan.
    """
    if name in df.columns:
        raise ValueError(f"the frame has a column {name!r}")
    if len(shares) < 1 or min(shares) < 0 or abs(math.fsum(shares) - 1) > 1e-9:
        raise ValueError("shares must be non-negative and add up to 1")
    cuts = _cuts(df.select(ref(label).alias("label"), row_hash(df, seed, columns).alias("key")), shares)
    keyed = df.withColumn("__key", row_hash(df, seed, columns))
    key, fold, tied = F.col("__key"), F.lit(0), F.lit(False)
    for cut in cuts:
        # A cut that takes a whole range leaves the hashes after it; one inside a hash leaves, so far, that hash too.
        after = key >= (cut.first if cut.splits_equals else cut.end if cut.need else 0)
        mine = _is(label, cut.label)
        fold = fold + F.when(mine & after, 1).otherwise(0)
        if cut.splits_equals and cut.need:
            tied = tied | (mine & (key == cut.first))
    tied = F.coalesce(tied, F.lit(False))
    partly = [c for c in cuts if c.splits_equals and c.need]
    plain = keyed.where(~tied) if partly else keyed
    out = plain.withColumn(name, fold.cast("int")).drop("__key")
    return out.unionByName(_numbered(keyed.where(tied), label, name, fold, partly)) if partly else out


def _numbered(tied: DataFrame, label: str, name: str, fold: Column, cuts: Sequence[_Cut]) -> DataFrame:
    """The folds of rows whose hash a cut goes through."""
    staged = stage_parquet(tied.withColumn(name, fold.cast("int")), run_folder(tied.sparkSession, "folds"))
    parts = staged.withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__id", 33))
    group = [ref(label), F.col("__key")]
    before = Window.partitionBy("__label", "__of").orderBy("__in").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        parts.groupBy(ref(label).alias("__label"), F.col("__key").alias("__of"), F.col("__part").alias("__in"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    mine = Window.partitionBy(*group, "__part").orderBy("__id")
    same = ref(label).eqNullSafe(F.col("__label")) & (F.col("__key") == F.col("__of")) & (F.col("__part") == F.col("__in"))
    ranked = parts.withColumn("__row", F.row_number().over(mine)).join(counts, same)
    place = F.col("__start") + F.col("__row")
    back = F.lit(0)
    for cut in cuts:
        # Counted as after the cut so far; the first `need` of them are before it.
        back = back + F.when(_is(label, cut.label) & (F.col("__key") == cut.first) & (place <= cut.need), 1).otherwise(0)
    columns = [c for c in staged.columns if c not in ("__key", name)]
    return ranked.select(*map(ref, columns), (F.col(name) - back).cast("int").alias(name))


def held_out_split(df: DataFrame, label: str, share: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rows to train on, rows held out): the share of every class, to the row."""
    parts = with_fold(df, label, [1 - share, share], seed, name="__held_out")
    return tuple(parts.where(F.col("__held_out") == k).drop("__held_out") for k in (0, 1))
