"""Small column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ref(name: str) -> Column:
    """Column reference by exact name, safe for dots and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the type can hold NaN."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return ref(name).isNull() | F.isnan(ref(name))
    return ref(name).isNull()


def row_weight(name: str) -> Column:
    """How many rows a row counts for: NULL is 0, a negative number or NaN stops the job."""
    w = ref(name)
    stop = F.raise_error(F.lit(f"negative weight or NaN in {name}"))
    return F.when((w < 0) | F.isnan(w.cast("double")), stop).otherwise(F.coalesce(w, F.lit(0)))


def share(part: Column, whole: Column) -> Column:
    """part / whole as double; NULL when the whole is zero (never an ANSI error)."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
