"""Column expressions shared by the operators. All of them are JVM-side built-ins."""

from tallyframe.functions.columns import is_missing, ref, row_weight, share
from tallyframe.functions.probabilities import class_probability, confidence, probability_array

__all__ = [
    "class_probability",
    "confidence",
    "is_missing",
    "probability_array",
    "ref",
    "row_weight",
    "share",
]
