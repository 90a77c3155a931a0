"""People tables derived from the driver's ``lineitem`` and ``part`` tables.

One person per line item; education and weekly hours come from its part. The part key is
unique, so the left join neither adds nor drops people, and it is left out when no wanted
column needs it: most profiling queries then scan ``lineitem`` alone, with no shuffle before
their aggregation. No join hint is given: Spark broadcasts ``part`` only below its own size
threshold and otherwise shuffles, splitting skewed keys adaptively.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PEOPLE_COLUMNS = ("age", "sex", "workclass", "fnlwgt", "education", "hours_per_week", "label")

# Column expressions of the proxy (fixed values).
_EXPRESSIONS = {
    "age": "cast(l_quantity as int)",
    "sex": "l_linestatus",
    "workclass": "l_returnflag",
    "fnlwgt": "cast(floor(l_extendedprice) as int)",
    "education": "p_type",
    "hours_per_week": "p_size",
    "label": "case when l_extendedprice * (1 - l_discount) > 50000 then '>50K' else '<=50K' end",
}
_FROM_PART = {"education", "hours_per_week"}

# Label values in the index order of the frozen scorer: class 1 is '<=50K'.
FROZEN_LABELS = [">50K", "<=50K"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a table scan out to all cores when its files split into fewer parts.

    Takes a bare scan, so that counting its partitions only plans and runs nothing. A table
    with a part for every core, as any large one, is left alone: no shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def people(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] = PEOPLE_COLUMNS,
    for_training: bool = False,
) -> DataFrame:
    """The people columns; ``for_training`` spreads small tables for the many passes of a fit."""
    rows = read_table(spark, sf_dir, "lineitem")
    if for_training:
        rows = spread(rows)
    if _FROM_PART.intersection(columns):
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
        rows = rows.join(part, rows["l_partkey"] == part["p_partkey"], "left")
    return rows.select(*[F.expr(_EXPRESSIONS[c]).alias(c) for c in columns])


def people_nulls(spark: SparkSession, sf_dir: str, columns: Sequence[str] = PEOPLE_COLUMNS) -> DataFrame:
    """People with missing values: age 13, workclass N, and label '>50K' at 7 weekly hours.

    ``age_or_nan`` is the age as double, NULL at 13 and NaN at 7.
    """
    holes = {
        "age": F.expr("nullif(age, 13)"),
        "age_or_nan": F.expr(
            "case when age = 7 then cast('NaN' as double) else cast(nullif(age, 13) as double) end"
        ),
        "workclass": F.expr("nullif(workclass, 'N')"),
        "label": F.expr("if(hours_per_week = 7, nullif(label, '>50K'), label)"),
    }
    needed = {"age" if c == "age_or_nan" else c for c in columns}
    if "label" in columns:
        needed.add("hours_per_week")
    base = people(spark, sf_dir, [c for c in PEOPLE_COLUMNS if c in needed])
    return base.select(*[holes.get(c, F.col(c)).alias(c) for c in columns])


def frozen_scores(people_df: DataFrame) -> DataFrame:
    """People scored by a fixed logistic function, so that what reads scores has exact results.

    Adds label_indexed, probability (a vector, as a fitted model gives) and prediction.
    """
    z = F.expr("4.0D - 0.00008D * fnlwgt + 0.01D * (age - 25) + if(workclass = 'A', 0.2D, 0.0D)")
    return (
        people_df.withColumn("label_indexed", F.expr("if(label = '<=50K', 1.0D, 0.0D)"))
        .withColumn("p1", F.round(1.0 / (1.0 + F.exp(-z)), 12))
        .withColumn("prediction", F.expr("if(p1 > 0.5D, 1.0D, 0.0D)"))
        .withColumn("probability", array_to_vector(F.array(F.round(1.0 - F.col("p1"), 12), F.col("p1"))))
        .drop("p1")
    )
