"""Numeric summaries with exact, linearly interpolated quantiles.

The built-in exact ``percentile`` keeps every distinct value of a column in one aggregation
buffer, which no single task can hold for a wide-ranging column at scale. Here a quantile is
found by narrowing: count rows per bucket, take the few buckets that hold the wanted ranks, split
only those again, and rank values one by one once a bucket is small.

Buckets are ranges of an order-preserving integer key of the doubles (``sort_keys``), so their number
does not depend on how the values are spread: a pass leaves 1 / ``BUCKETS`` of a bracket's keys, and
five passes are the most there can be for 64-bit values. Each is a pruned scan with map-side
aggregation that shuffles bucket counts only; a value shared by a third of the rows is one
count. What reaches the driver per pass is bounded by the parameters (two ranks per quantile and
column), never by the data, and a task ranks at most ``direct_values`` values of a bracket. A column
of up to so many rows, or of integers in a range of that length, takes two scans: moments and ranking.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import ref, row_weight
from tallyframe.functions.sort_keys import with_sort_key

QUARTILES = (0.25, 0.5, 0.75)

# Buckets per pass and bracket: few enough for each task to fold its rows into a small table.
BUCKETS = 2**14

# A bracket of at most this many rows or distinct values is ranked value by value.
DIRECT_VALUES = 2**16

Rank = tuple[int, int]  # (position of the quantile in the list, 0 below / 1 above)


def _half_key(value: float) -> int:
    """Half of the sort key of a double, so that differences of two fit 64 bits."""
    bits = struct.unpack(">q", struct.pack(">d", abs(value)))[0]
    return (-bits if value < 0 else bits) >> 1


@dataclass
class _Bracket:
    """A range of the values of one column (by position) and the ranks wanted from it, relative to its start."""

    slot: int
    low: float
    high: float
    rows: int
    ranks: dict[Rank, int] = field(default_factory=dict)
    integral: bool = False

    def direct(self, most: int) -> bool:
        values = min(self.rows, self.high - self.low + 1) if self.integral else self.rows
        # Two doubles at most share half a key.
        return values <= most or _half_key(self.low) == _half_key(self.high)

    @property
    def single(self) -> bool:
        return self.low == self.high

    def holds(self) -> str:
        """SQL condition on (name, value); column number i goes by the name v<i>."""
        return f"name = 'v{self.slot}' AND value BETWEEN {_sql(self.low)} AND {_sql(self.high)}"

    def bucket(self) -> str:
        """Number of the range of keys, all of the same length, that holds a value's key."""
        low, high = _half_key(self.low), _half_key(self.high)
        return f"(shiftright(key, 1) - ({low}L)) DIV {(high - low) // BUCKETS + 1}L"


def _sql(value: float) -> str:
    """A double literal that reads back as exactly this value."""
    return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"


def _has(number: int, rank: int) -> str:
    """SQL condition on a counted bucket or value: it holds this rank of this bracket."""
    return f"(bracket = {number} AND start <= {rank}L AND start + n > {rank}L)"


def _wanted(brackets: Sequence[_Bracket]) -> str:
    return " OR ".join(_has(i, rank) for i, b in enumerate(brackets) for rank in sorted(set(b.ranks.values())))


def _in_brackets(values: DataFrame, brackets: Sequence[_Bracket]) -> DataFrame:
    """``(bracket, value)`` of the values inside the brackets, in one scan for all columns.

    The brackets are told apart after the unpivot, which computes each value once; tests on
    the input columns would make the optimizer copy whatever expression defines them.
    """
    number = "CASE " + " ".join(f"WHEN {b.holds()} THEN {i}" for i, b in enumerate(brackets)) + " END"
    return values.selectExpr(f"{number} AS bracket", "* EXCEPT (name)").where("bracket IS NOT NULL")


def _tally(values: DataFrame) -> Column:
    """How many rows the values count for: their weights, where they have any."""
    return F.sum("weight") if "weight" in values.columns else F.count(F.lit(1))


def _with_start(counted: DataFrame, order: str) -> DataFrame:
    """Number of the bracket's values before each bucket or value."""
    upto = Window.partitionBy("bracket").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumn("start", F.sum("n").over(upto) - F.col("n"))


def _split(values: DataFrame, brackets: Sequence[_Bracket]) -> list[_Bracket]:
    """One narrowing pass over brackets too large to rank directly."""
    bucket = "CASE bracket " + " ".join(f"WHEN {i} THEN {b.bucket()}" for i, b in enumerate(brackets)) + " END"
    counted = (
        with_sort_key(_in_brackets(values, brackets), 64)
        .groupBy("bracket", F.expr(bucket).alias("bucket"))
        .agg(
            _tally(values).alias("n"),
            F.count(F.lit(1)).alias("held"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )
    narrowed = []
    for row in _with_start(counted, "bucket").where(_wanted(brackets)).collect():
        parent = brackets[row["bracket"]]
        ranks = {
            key: rank - row["start"]
            for key, rank in parent.ranks.items()
            if row["start"] <= rank < row["start"] + row["n"]
        }
        narrowed.append(_Bracket(parent.slot, row["low"], row["high"], row["held"], ranks, parent.integral))
    return narrowed


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    direct_values: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """count, mean, sample stddev, min, quantiles and max per column; NULL and NaN are skipped.

    One row per column: ``column, n, mean, stddev, min, p25, p50, p75, max`` (for quartiles).
    A column without values gives n = 0 and NULL statistics. The moments and the narrowing run
    when this is called, the last pass when the result is read. ``direct_values`` is how many values
    of a bracket one task may rank (``DIRECT_VALUES`` if not given).

    ``weight`` names a column of whole numbers: how many equal rows a row stands for. All results, ``n`` and the
    ranks of the quantiles included, are those of the repeated rows, which are never made. NULL and 0 leave a
    row out, a negative weight stops the job. One more pass sums the squared deviations.
    """
    most = DIRECT_VALUES if direct_values is None else direct_values
    slots = [f"v{i}" for i in range(len(columns))]
    numbers = [ref(c).cast("double").alias(v) for c, v in zip(columns, slots)]
    if weight is None:
        numbered, kept = df.select(*numbers), []
        moments = _moments(numbered)
    else:
        if not isinstance(df.schema[weight].dataType, T.IntegralType):
            raise ValueError(f"weights must be whole numbers, {weight!r} is {df.schema[weight].dataType.simpleString()}")
        numbered, kept = df.select(*numbers, row_weight(weight).cast("bigint").alias("weight")).where("weight > 0"), ["weight"]
        moments = _weighted_moments(numbered, slots)

    types = [df.schema[c].dataType for c in columns]
    brackets, fractions = [], {}
    for slot, m in enumerate(moments):
        if not m["n"]:
            continue
        ranks = {}
        for q, p in enumerate(probabilities):
            position = p * (m["n"] - 1)
            ranks[q, 0], ranks[q, 1] = math.floor(position), math.ceil(position)
            fractions[slot, q] = position - math.floor(position)
        integral = isinstance(types[slot], T.IntegralType)
        brackets.append(_Bracket(slot, m["min"], m["max"], m.get("held", m["n"]), ranks, integral))

    values = numbered.unpivot(kept, slots, "name", "value").where("value IS NOT NULL AND NOT isnan(value)")
    while large := [b for b in brackets if not b.direct(most)]:
        brackets = [b for b in brackets if b not in large] + _split(values, large)

    # SQL expressions of the wanted values: literals where a bracket has shrunk to one value,
    # else picked from the values of the remaining brackets.
    known = {(b.slot, key): _sql(b.low) for b in brackets if b.single for key in b.ranks}
    rest = [b for b in brackets if not b.single]
    if rest:
        counted = _in_brackets(values, rest).groupBy("bracket", "value").agg(_tally(values).alias("n"))
        picks = {(b.slot, key): _has(i, rank) for i, b in enumerate(rest) for key, rank in b.ranks.items()}
        found = (
            _with_start(counted, "value")
            .where(_wanted(rest))
            .agg(*[F.expr(f"max(CASE WHEN {has} THEN value END) AS p{i}") for i, has in enumerate(picks.values())])
        )
        known |= {target: f"p{i}" for i, target in enumerate(picks)}
    else:
        found = df.sparkSession.range(1)

    def quantile(slot: int, q: int) -> str:
        if (slot, q) not in fractions:
            return "double(NULL)"
        low, high = known[slot, (q, 0)], known[slot, (q, 1)]
        fraction = fractions[slot, q]
        return low if fraction == 0 else f"{low} + ({high} - {low}) * {_sql(fraction)}"

    def moment(slot: int, name: str) -> str:
        value = moments[slot][name]
        return "double(NULL)" if value is None else _sql(value)

    rows = []
    for slot in range(len(columns)):
        quantiles = ", ".join(f"{quantile(slot, q)} AS p{q}" for q in range(len(probabilities)))
        rows.append(
            f"struct({slot} AS slot, {moments[slot]['n']}L AS n, {moment(slot, 'mean')} AS mean, "
            f"{moment(slot, 'stddev')} AS stddev, {moment(slot, 'min')} AS min, {quantiles}, "
            f"{moment(slot, 'max')} AS max)"
        )
    return found.select(F.inline(F.expr(f"array({', '.join(rows)})"))).select(
        F.get(F.lit(list(columns)), F.col("slot")).alias("column"),
        "n",
        "mean",
        "stddev",
        "min",
        *[F.col(f"p{q}").alias(f"p{100 * p:g}") for q, p in enumerate(probabilities)],
        "max",
    )


def _moments(numbered: DataFrame) -> list[dict]:
    """Count, mean, stddev and range of every column in one global aggregation."""
    measures = [
        f"{measure} AS {v}_{name}"
        for v in numbered.columns
        for name, measure in {
            "n": f"count(nanvl({v}, NULL))",
            "mean": f"avg(nanvl({v}, NULL))",
            "stddev": f"stddev_samp(nanvl({v}, NULL))",
            "min": f"min(nanvl({v}, NULL))",
            "max": f"max(nanvl({v}, NULL))",
        }.items()
    ]
    return _by_column(numbered.selectExpr(*measures), numbered.columns)


def _weighted_moments(numbered: DataFrame, slots: Sequence[str]) -> list[dict]:
    """The same of the rows that the weights stand for, and how many values are held; the deviations in a second pass.

    Squares of deviations from the known mean add up without the cancellation that sums of squares suffer.
    """
    measures = []
    for v in slots:
        own = f"CASE WHEN {v} IS NOT NULL AND NOT isnan({v}) THEN weight END"
        measures += [
            f"coalesce(sum({own}), 0L) AS {v}_n",
            f"count({own}) AS {v}_held",
            f"sum(nanvl({v}, NULL) * weight) / sum({own}) AS {v}_mean",
            f"min(nanvl({v}, NULL)) AS {v}_min",
            f"max(nanvl({v}, NULL)) AS {v}_max",
        ]
    found = _by_column(numbered.selectExpr(*measures), slots)
    apart = {v: f"(nanvl({v}, NULL) - {_sql(m['mean'])})" for v, m in zip(slots, found) if m["n"] > 1}
    squares = {}
    if apart:
        squares = numbered.selectExpr(*[f"sum(weight * {d} * {d}) AS {v}" for v, d in apart.items()]).first().asDict()
    for v, m in zip(slots, found):
        m["stddev"] = math.sqrt(squares[v] / (m["n"] - 1)) if v in apart else None
    return found


def _by_column(measured: DataFrame, slots: Sequence[str]) -> list[dict]:
    """The measures of each column from the one row that has them all."""
    row = measured.first().asDict()
    return [{k.removeprefix(f"{v}_"): x for k, x in row.items() if k.startswith(f"{v}_")} for v in slots]
