"""Expressions over a class-probability column (an ML vector or an array of doubles)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import ref


def probability_array(df: DataFrame, name: str = "probability") -> Column:
    """The probabilities as array<double>, whatever the column holds them in."""
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return ref(name)
    return vector_to_array(ref(name))


def class_probability(df: DataFrame, name: str = "probability", index: int = 1) -> Column:
    """Probability of class ``index``; the first entry when the vector is shorter than that."""
    p = probability_array(df, name)
    return F.coalesce(F.get(p, F.lit(index)), F.get(p, F.lit(0)))


def confidence(df: DataFrame, name: str = "probability") -> Column:
    """Largest class probability of the row."""
    return F.array_max(probability_array(df, name))
