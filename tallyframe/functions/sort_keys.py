"""Order-preserving integer keys for numeric columns.

``a < b`` exactly when ``key(a) < key(b)``, so a range of values can be narrowed by the
leading bits of the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEY_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32}

# IEEE-754 binary64 layout (fixed values).
_MANTISSA_BITS = 52
_EXPONENT_BIAS = 1023
_MIN_NORMAL = 2.0**-1022
_INFINITY_BITS = 0x7FF << _MANTISSA_BITS


def key_bits(df: DataFrame, name: str) -> int:
    """Width of the key of a column; every type but the short integers is keyed as a double."""
    return _KEY_BITS.get(type(df.schema[name].dataType), 64)


def with_sort_key(df: DataFrame, bits: int) -> DataFrame:
    """Add ``key`` for the double column ``value`` (not NULL, not NaN).

    Up to 32 bits the values are integers and the key is the value. Otherwise it is the
    signed magnitude of the IEEE-754 bit pattern, in exact double arithmetic: scaling by a
    power of two is exact, so the mantissa comes out bit for bit; the exponent from ``log2``
    may be one off next to a power of two and is corrected by comparison. Each step is its own
    projection, so that nothing is computed twice.
    """
    value = F.col("value")
    if bits <= 32:
        return df.withColumn("key", F.coalesce(value.cast("long"), F.lit(0).cast("long")))

    two = F.lit(2.0)
    size, guess, exponent = F.col("__size"), F.col("__guess"), F.col("__exponent")
    stepped = (
        df.withColumn("__size", F.abs(value))
        .withColumn("__guess", F.least(F.floor(F.log2(size)), F.lit(1024)).cast("int"))
        .withColumn(
            "__exponent",
            guess + F.when(F.pow(two, guess) > size, -1).when(F.pow(two, guess + 1) <= size, 1).otherwise(0),
        )
        .withColumn(
            "__bits",
            F.when(size == 0, F.lit(0).cast("long"))
            .when(size == float("inf"), F.lit(_INFINITY_BITS).cast("long"))
            .when(size < _MIN_NORMAL, (size * 2.0**1000 * 2.0**74).cast("long"))
            .otherwise(
                (exponent.cast("long") + _EXPONENT_BIAS) * (1 << _MANTISSA_BITS)
                + ((size / F.pow(two, exponent) - 1) * 2.0**_MANTISSA_BITS).cast("long")
            ),
        )
    )
    key = F.when(value < 0, -F.col("__bits")).otherwise(F.col("__bits"))
    # Never NULL here; saying so keeps the optimizer from copying the key into a NULL filter.
    return stepped.withColumn("key", F.coalesce(key, F.lit(0).cast("long"))).drop(
        "__size", "__guess", "__exponent", "__bits"
    )
