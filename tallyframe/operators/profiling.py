"""Profiling: counts, schema, describe, missing values, label distribution, crosstabs.

Everything is one aggregation over the columns it names (generic in those columns), so the
scan is pruned, the aggregation is partial before any shuffle, and the result is as large as
the number of columns or groups. Functions that count rows take an optional ``weight`` column
and then sum it instead, which lets them run over a pre-aggregated table such as
:func:`category_cells`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import is_missing, ref, share


def _tally(condition: Column | None, weight: str | None) -> Column:
    """Rows (or their weights) for which the condition holds, as a non-NULL long."""
    if weight is None:
        return F.count(F.lit(1)) if condition is None else F.count_if(condition)
    amount = ref(weight) if condition is None else F.when(condition, ref(weight))
    return F.coalesce(F.sum(amount), F.lit(0)).cast("long")


def _one_row_per_column(df: DataFrame, columns: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Aggregate all columns in a single pass, then lay the one result row out as rows."""
    wide = df.agg(
        *[e.alias(f"{i}_{stat}") for i, stats in enumerate(columns.values()) for stat, e in stats.items()]
    )
    rows = [
        F.struct(F.lit(name).alias("column"), *[F.col(f"{i}_{stat}").alias(stat) for stat in stats])
        for i, (name, stats) in enumerate(columns.items())
    ]
    return wide.select(F.inline(F.array(*rows)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def schema_listing(df: DataFrame) -> DataFrame:
    """Position, name, type, nullability and number of filled values of every column."""
    fields = df.schema.fields
    filled = df.agg(*[F.count(ref(f.name)).alias(f"filled_{i}") for i, f in enumerate(fields)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.nullable).alias("nullable"),
            F.col(f"filled_{i}").alias("filled"),
        )
        for i, f in enumerate(fields)
    ]
    return filled.select(F.inline(F.array(*rows)))


def head_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """First n rows in the order of all columns: per-partition top n, then one merge."""
    return df.orderBy(*[ref(c) for c in df.columns]).limit(n)


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample stddev, min, max per numeric column."""
    return _one_row_per_column(
        df,
        {
            c: {
                "count": F.count(ref(c)),
                "mean": F.avg(ref(c)),
                "stddev": F.stddev_samp(ref(c)),
                "min": F.min(ref(c)).cast("double"),
                "max": F.max(ref(c)).cast("double"),
            }
            for c in columns
        },
    )


def describe_string(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, min, max per string column; mean and stddev are NULL, as a string has none."""
    return _one_row_per_column(
        df,
        {c: {"count": F.count(ref(c)), "min": F.min(ref(c)), "max": F.max(ref(c))} for c in columns},
    ).select(
        "column",
        "count",
        F.lit(None).cast("double").alias("mean"),
        F.lit(None).cast("double").alias("stddev"),
        "min",
        "max",
    )


def column_profile(df: DataFrame, numeric: Sequence[str], strings: Sequence[str]) -> DataFrame:
    """Row count, describe and missing counts of all columns together, in one pass.

    One row per column; ``min`` and ``max`` are set for numbers, ``first`` and ``last`` (in
    value order) for strings.
    """
    columns = [*numeric, *strings]
    floats = [c for c in numeric if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    wide = {"n_rows": F.count(F.lit(1))} | {f"{c} count": F.count(ref(c)) for c in columns}
    wide |= {f"{c} missing": F.count_if(is_missing(df, c)) for c in floats}
    wide |= {f"{c} {name}": f(ref(c)) for c in columns for name, f in (("min", F.min), ("max", F.max))}
    wide |= {f"{c} {name}": f(ref(c)) for c in numeric for name, f in (("mean", F.avg), ("stddev", F.stddev_samp))}

    def measured(c: str, name: str, where: Sequence[str], kind: str) -> Column:
        return ref(f"{c} {name}").cast(kind) if c in where else F.lit(None).cast(kind)

    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("n_rows"),
            ref(f"{c} count").alias("count"),
            # Only a float can be missing without being NULL.
            (ref(f"{c} missing") if c in floats else F.col("n_rows") - ref(f"{c} count")).alias("missing"),
            *[measured(c, name, numeric, "double").alias(name) for name in ("mean", "stddev", "min", "max")],
            measured(c, "min", strings, "string").alias("first"),
            measured(c, "max", strings, "string").alias("last"),
        )
        for c in columns
    ]
    return df.agg(*[e.alias(name) for name, e in wide.items()]).select(F.inline(F.array(*rows)))


def profile_state(df: DataFrame, numeric: Sequence[str], strings: Sequence[str]) -> DataFrame:
    """The column profile of a part of a table in a form that merges: counts, means and squared deviations.

    One row per column: column, n_rows, count, missing, mean, squares, min, max, first, last. Written
    and unioned with the states of other parts, ``merged_profile`` gives the profile of all of them.
    """
    squares = (F.col("count") - 1) * F.col("stddev") * F.col("stddev")
    profile = column_profile(df, numeric, strings)
    return profile.withColumn("squares", F.when(F.col("count") == 1, F.lit(0.0)).otherwise(squares)).drop("stddev")


def merged_states(states: DataFrame) -> DataFrame:
    """One state per column, of all rows behind the given ones."""
    every = Window.partitionBy("column")
    n = F.sum("count").over(every)
    mean = F.try_divide(F.sum(F.col("mean") * F.col("count")).over(every), n)
    # The parts' squared deviations are from their own means; the rest is what their means deviate.
    apart = F.col("count") * (F.col("mean") - F.col("__mean")) * (F.col("mean") - F.col("__mean"))
    return (
        states.withColumn("__mean", mean)
        .groupBy("column")
        .agg(
            *[F.sum(c).alias(c) for c in ("n_rows", "count", "missing")],
            F.first("__mean").alias("mean"),
            (F.sum("squares") + F.sum(apart)).alias("squares"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
    )


def merged_profile(states: DataFrame) -> DataFrame:
    """The ``column_profile`` of the whole table from the states of its parts, which are small and may come one by one."""
    deviation = F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1)))
    return merged_states(states).select(
        "column", "n_rows", "count", "missing", "mean", deviation.alias("stddev"), "min", "max", "first", "last"
    )


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of missing values (NULL, or NaN for floats) of each column."""
    return df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in columns])


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    """The distinct label values, NULL being one of them."""
    return df.select(ref(label)).distinct()


def label_check(df: DataFrame, label: str) -> DataFrame:
    """How many distinct labels there are (NULL counts), and whether that makes a binary target."""
    n = F.count(F.lit(1))
    return distinct_labels(df, label).agg(n.alias("n_labels"), (n == 2).alias("is_binary"))


def label_distribution(df: DataFrame, label: str, weight: str | None = None) -> DataFrame:
    """Rows per non-NULL label, most frequent first."""
    return (
        df.where(ref(label).isNotNull())
        .groupBy(ref(label))
        .agg(_tally(None, weight).alias("count"))
        .orderBy(F.desc("count"), ref(label))
    )


def label_proportions(
    df: DataFrame, label: str, values: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Percent of all rows (NULL labels included) per given label; 0 if absent, NULL if no rows.

    No row if no label is given.
    """
    if not values:
        return df.select(ref(label).cast("string").alias(label), F.lit(0.0).alias("percent")).limit(0)
    return _one_row_per_column(
        df, {v: {"part": _tally(ref(label) == v, weight), "whole": _tally(None, weight)} for v in values}
    ).select(F.col("column").alias(label), (100 * share(F.col("part"), F.col("whole"))).alias("percent"))


def crosstab(
    df: DataFrame,
    key: str,
    label: str,
    values: Mapping[str, str],
    weight: str | None = None,
) -> DataFrame:
    """Rows per key and label, one column per label; ``values`` maps label value to column name.

    Rows with a NULL key or label do not count. Conditional counts need one shuffle of partial
    counts where a pivot needs two, and an absent cell is 0 without filling. Without values there is
    nothing to count, and no row.
    """
    if not values:
        return df.select(ref(key)).limit(0)
    return (
        df.where(ref(key).isNotNull() & ref(label).isNotNull())
        .groupBy(ref(key))
        .agg(*[_tally(ref(label) == v, weight).alias(name) for v, name in values.items()])
    )


def category_cells(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Rows per (column, value, label) for several categorical columns in one pass.

    Small enough to keep, and sufficient for the label distribution and every crosstab.
    """
    return (
        df.select(ref(label).alias("__label"), *[ref(k).cast("string").alias(k) for k in keys])
        .unpivot(["__label"], [ref(k) for k in keys], "column", "value")
        .groupBy("column", "value", F.col("__label").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
