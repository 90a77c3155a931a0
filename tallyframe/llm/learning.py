"""Labelled rows to learn from, shared by the learned operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor)).cast("int")


def in_fold(doc_id: Column, divisor: int, remainder: int) -> Column:
    return F.coalesce(crc_remainder(doc_id, divisor) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text and label (0 or 1) of at most ``most`` labelled documents, chosen by a hash of their ids.

    ``labels`` is filtered by the caller. An id labelled more than once has its most frequent label, 1
    on a tie; rows without id or label are not used. The sample is bounded, so its ids are broadcast.
    """
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))
    )
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
