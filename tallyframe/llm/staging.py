"""Tables that cut the lineage of multi-step operators, in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sources.staging import shared_folder


class Workspace:
    """Intermediate tables of one call of an operator.

    ``keep`` writes a frame to a folder of its own and reads it back, so that later steps depend on
    a durable table whatever executors are lost meanwhile. ``drop`` deletes tables no step reads
    any longer. The tables a returned frame reads stay.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._paths: dict[int, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self._paths)}-{uuid.uuid4().hex[:6]}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(table)] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(table)))
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*[F.col(f"`{c}`") for c in columns])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until the frame has no such column, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]
