"""Running totals over a whole table in the order of a key, without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions import ref
from tallyframe.sources.staging import run_folder, stage_parquet


def with_running_totals(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """Add, for each ``name: column`` of ``sums``, the total of the column from the first row up to this one.

    Rows are dealt to tasks by ranges of the order and written once. A range's total is a single row, and
    only those rows are summed up in one place; inside a range a window adds up its own rows. Rows that are equal
    in ``order`` share a range, so group them first where many may be.
    """
    part = "__part"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(part, F.spark_partition_id())
    staged = stage_parquet(ranged, run_folder(df.sparkSession, "running"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        staged.groupBy(part)
        .agg(*[F.sum(ref(c)).alias(f"__{i}") for i, c in enumerate(sums.values())])
        .select(part, *[F.coalesce(F.sum(f"__{i}").over(before), F.lit(0)).alias(f"__{i}") for i in range(len(sums))])
    )
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {name: F.col(f"__{i}") + F.sum(ref(c)).over(inside) for i, (name, c) in enumerate(sums.items())}
    return staged.join(starts, part).withColumns(totals).select(*[ref(c) for c in df.columns], *map(ref, sums))
