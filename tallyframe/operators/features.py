"""Feature stages: category indexes, one-hot slots, assembly."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import ref, row_weight


def indexed(column: str) -> str:
    return f"{column}_indexed"


def encoded(column: str) -> str:
    return f"{column}_encoded"


def category_counts(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Rows (or their weights) per (column, value) of several categorical columns, in one pass; NULL is left out."""
    values = [ref(c).cast("string").alias(c) for c in columns]
    if weight is None:
        long = df.select(*values).unpivot([], [ref(c) for c in columns], "column", "value")
        n = F.count(F.lit(1))
    else:
        # The entries go by position, so that a column named like the weight stays apart.
        entries = [F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in zip(columns, values)]
        long = df.select(row_weight(weight).alias("weight"), F.explode(F.array(*entries)).alias("e")).select("weight", "e.*")
        n = F.sum("weight")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(n.alias("n"))


def category_labels(
    df: DataFrame, columns: Sequence[str], max_values: int | None = None, weight: str | None = None
) -> dict[str, list[str]]:
    """Values of each categorical column, most frequent (by weight, if given) first, ties in value order.

    One scan for all columns. The lists live on the driver and in every scoring task, as in any
    Spark ML indexer; with ``max_values``, more values than that in all columns together raise.
    """
    counts = category_counts(df, columns, weight)
    rows = (counts if max_values is None else counts.limit(max_values + 1)).collect()
    if max_values is not None and len(rows) > max_values:
        raise ValueError(f"more than {max_values} distinct values in the categorical columns {list(columns)}")
    labels: dict[str, list[str]] = {c: [] for c in columns}
    for row in sorted(rows, key=lambda r: (-r["n"], r["value"])):
        labels[row["column"]].append(row["value"])
    empty = [c for c, values in labels.items() if not values]
    if empty:
        raise ValueError(f"categorical columns without any value: {empty}")
    return labels


def category_indexers(labels: dict[str, list[str]], handle_invalid: str = "keep") -> list[StringIndexerModel]:
    """One index stage per column, by its label list; with ``keep``, NULL and unseen values
    share the index after the last label."""
    return [
        StringIndexerModel.from_labels(
            values, inputCol=c, outputCol=indexed(c), handleInvalid=handle_invalid
        )
        for c, values in labels.items()
    ]


def one_hot(columns: Sequence[str]) -> OneHotEncoder:
    """One slot per value. The last slot (the unknown bucket of a ``keep`` index) is dropped,
    so NULL and unseen values give an all-zero vector."""
    return OneHotEncoder(
        inputCols=[indexed(c) for c in columns], outputCols=[encoded(c) for c in columns], dropLast=True
    )


def assembler(
    numeric: Sequence[str], categorical: Sequence[str], handle_invalid: str = "error"
) -> VectorAssembler:
    """Numeric columns first, then the one-hot slots of each categorical column."""
    return VectorAssembler(
        inputCols=[*numeric, *[encoded(c) for c in categorical]],
        outputCol="features",
        handleInvalid=handle_invalid,
    )


def index_counts(indexed_df: DataFrame, column: str) -> DataFrame:
    """Rows per (value, index) of an indexed column, NULL included."""
    return indexed_df.groupBy(ref(column).alias("value"), ref(indexed(column)).alias("index")).agg(
        F.count(F.lit(1)).alias("n")
    )


def slot_names(assembled: DataFrame, vector: str = "features") -> list[str]:
    """Slot names in slot order, from the metadata that the feature stages leave on the column."""
    groups = assembled.schema[vector].metadata["ml_attr"]["attrs"].values()
    return [a["name"] for a in sorted((a for group in groups for a in group), key=lambda a: a["idx"])]


def slot_totals(assembled: DataFrame, vector: str = "features") -> DataFrame:
    """Sum and number of non-zero entries per slot: ``slot, feature, total, exact_total, non_zero``.

    Only stored entries are laid out as rows: one per column of a sparse row, not one per slot.
    They are summed per task before the shuffle, which moves one row per slot and task.
    ``exact_total`` is exact past 2**53 too: whole entries below 2**53 are summed in two halves of a long, others as
    decimals; it is NULL for a slot with an entry that nine decimals do not hold exactly. (The
    vector summarizer derives sums from means, which is inexact.)
    """
    vectors = assembled.select(F.unwrap_udt(ref(vector)).alias("v")).select(
        F.coalesce("v.indices", F.sequence(F.lit(0), F.size("v.values") - 1)).alias("slot"),
        F.col("v.values").alias("entry"),
    )
    names = slot_names(assembled, vector)
    every_slot = assembled.sparkSession.range(len(names)).select(
        F.col("id").cast("int").alias("slot"), F.lit(0.0).alias("entry")
    )
    entries = vectors.select(F.inline(F.arrays_zip("slot", "entry"))).unionByName(every_slot)
    whole = F.expr("entry = floor(entry) AND abs(entry) < 9007199254740992D")
    count = F.expr("CASE WHEN entry = floor(entry) AND abs(entry) < 9007199254740992D THEN cast(entry AS bigint) END")
    # Where all entries are whole, as most slots' are, these are NULL and cost nothing.
    broken = F.when(~F.col("whole"), F.expr("try_cast(entry AS decimal(28, 9))"))
    held = F.col("whole") | F.coalesce(F.col("broken").cast("double") == F.col("entry"), F.lit(False))
    entries = entries.select("slot", "entry", whole.alias("whole"), count.alias("count")).withColumn("broken", broken)
    high, low = F.sum(F.shiftright("count", 26)), F.sum(F.col("count").bitwiseAND(F.lit((1 << 26) - 1)))
    wide = "decimal(38, 9)"
    exact = (
        F.coalesce(high, F.lit(0)).cast("decimal(28, 0)") * F.lit(1 << 26) + F.coalesce(low, F.lit(0))
    ).cast(wide) + F.coalesce(F.sum("broken"), F.lit(0)).cast(wide)
    feature = F.from_json(F.lit(json.dumps(names)), "array<string>")
    return (
        entries.groupBy("slot")
        .agg(
            F.sum("entry").alias("total"),
            F.when(F.bool_and(held), exact.cast(wide)).alias("exact_total"),
            F.count_if(F.col("entry") != 0).alias("non_zero"),
        )
        .select(
            "slot",
            F.get(feature, F.col("slot")).alias("feature"),
            F.coalesce(F.col("exact_total").cast("double"), F.col("total")).alias("total"),
            "exact_total",
            "non_zero",
        )
    )
