"""Typed CSV scans of people tables: declared schema, header line, no inference.

The schema binds by position whatever the header says. A field that does not parse becomes
NULL and the row stays; an empty field is NULL; short rows are filled with NULL, extra fields
dropped, blank lines skipped, and spaces kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import ref
from tallyframe.sources.staging import stage_parquet

# Column names, order and types of the two CSV files (fixed values).
FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("age", T.IntegerType()),
        T.StructField("sex", T.StringType()),
        T.StructField("workclass", T.StringType()),
        T.StructField("fnlwgt", T.IntegerType()),
        T.StructField("education", T.StringType()),
        T.StructField("hours_per_week", T.IntegerType()),
    ]
)
LABELLED_SCHEMA = T.StructType([*FEATURE_SCHEMA.fields, T.StructField("label", T.StringType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """Training rows: six features and the label."""
    return read_csv(spark, path, LABELLED_SCHEMA)


def read_unlabelled(spark: SparkSession, path: str) -> DataFrame:
    """Rows to score: the six features."""
    return read_csv(spark, path, FEATURE_SCHEMA)


RAW = "raw_line"


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType, staged: str, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(all rows as :func:`read_csv` reads them, the rows that did not parse); parsed once, into the folder ``staged``.

    A row that did not parse also has its ``raw_line`` and its ``faults``, an array of cause and column: ``short`` and
    ``long`` rows have no column, ``unreadable`` fields name theirs.
    """
    with_raw = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
    # All columns are asked for: the reader checks only the fields it is asked for.
    parsed = (
        spark.read.schema(with_raw)
        .option("header", header)
        .option("columnNameOfCorruptRecord", RAW)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    rows = stage_parquet(parsed, staged)
    bad = rows.where(F.col(RAW).isNotNull()).withColumn("faults", _faults(schema))
    return rows.drop(RAW), bad


def _faults(schema: T.StructType):
    """What is wrong with a raw line, by reading it again as text with as many fields, and with one more."""
    mark = "__unread"
    texts = ", ".join(f"f{i} string" for i in range(len(schema)))
    options = {"columnNameOfCorruptRecord": mark, "mode": "PERMISSIVE"}
    exact = F.from_csv(F.col(RAW), f"{texts}, {mark} string", options)
    wider = F.from_csv(F.col(RAW), f"{texts}, more string, {mark} string", options)
    is_long = exact[mark].isNotNull() & (wider[mark].isNull() | wider["more"].isNotNull())

    def fault(cause: str, column: str | None):
        return F.struct(F.lit(cause).alias("cause"), F.lit(column).cast("string").alias("column"))

    found = [F.when(is_long, fault("long", None)), F.when(exact[mark].isNotNull() & ~is_long, fault("short", None))]
    found += [
        F.when(ref(f.name).isNull() & (F.length(exact[f"f{i}"]) > 0), fault("unreadable", f.name)) for i, f in enumerate(schema.fields)
    ]
    return F.array_compact(F.array(*found))


def fault_counts(rejected: DataFrame) -> DataFrame:
    """Rows by cause and column; a row with several faults counts for each."""
    faults = rejected.select(F.explode("faults").alias("fault"))
    return faults.groupBy(F.col("fault.cause").alias("cause"), F.col("fault.column").alias("column")).agg(F.count(F.lit(1)).alias("n"))
