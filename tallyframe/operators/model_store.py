"""Linear models saved as tables, in versions that appear whole or not at all.

A version's data is written to a folder of its own, which nobody looks at until a small file names
it: ``<root>/published/<version>``. That file is written aside and renamed, which on a file system such as HDFS
is one step that fails where the name exists: of two writers one gets the number and the other takes the next. A writer
that dies before leaves only folders and files that nothing names. Loading reads two narrow tables, bounded by the model.
"""

from __future__ import annotations

import dataclasses
import json
import uuid

from pyspark.sql import SparkSession

from tallyframe.operators.model import Classifier, ModelParams
from tallyframe.operators.scoring import LinearModel, linear_model

FORMAT = 1

WEIGHTS = "class_index int, slot int, feature string, weight double"
LABELS = "column string, position int, value string"


def _folder(spark: SparkSession, path: str):
    """A path of the file system the root is on, and that file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions, oldest first."""
    at, files = _folder(spark, f"{root}/published")
    if not files.exists(at):
        return []
    return sorted(int(f.getPath().getName()) for f in files.listStatus(at) if f.getPath().getName().isdigit())


def save_model(spark: SparkSession, model: Classifier | LinearModel, root: str) -> int:
    """Write the model as the next version; returns its number."""
    model = linear_model(model)
    data = f"{root}/data/{uuid.uuid4().hex}"
    names = ["intercept", *model.slots]
    weights = [
        (k, slot, name, float(w))
        for k, (b, row) in enumerate(zip(model.intercepts, model.weights))
        for slot, (name, w) in enumerate(zip(names, [b, *row]), start=-1)
    ]
    labels = [(c, i, v) for c, values in model.category_labels.items() for i, v in enumerate(values)]
    spark.createDataFrame(weights, WEIGHTS).coalesce(1).write.parquet(f"{data}/weights")
    spark.createDataFrame(labels, LABELS).coalesce(1).write.parquet(f"{data}/labels")
    told = json.dumps({"format": FORMAT, "data": data, "params": dataclasses.asdict(model.params)})
    version = max(versions(spark, root), default=0) + 1
    while not _publish(spark, f"{root}/published", version, told):
        version += 1
    return version


def _publish(spark: SparkSession, folder: str, version: int, told: str) -> bool:
    """Write the file that names a version, unless there is one. Written aside and renamed, so never seen half."""
    aside, files = _folder(spark, f"{folder}/.{version}-{uuid.uuid4().hex}")
    named, _ = _folder(spark, f"{folder}/{version}")
    out = files.create(aside, False)
    out.write(told.encode("utf-8"))
    out.close()
    if not files.exists(named) and files.rename(aside, named):
        return True
    files.delete(aside, False)
    return False


def load_model(spark: SparkSession, root: str, version: int | None = None) -> LinearModel:
    """A published version, the latest if none is named."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise ValueError(f"no version {version or ''} of a model in {root}; it has {known}")
    told = json.loads(spark.read.text(f"{root}/published/{version or known[-1]}", wholetext=True).first()[0])
    if told["format"] != FORMAT:
        raise ValueError(f"the model is of format {told['format']}, this code reads {FORMAT}")
    weights = spark.read.schema(WEIGHTS).parquet(f"{told['data']}/weights").orderBy("class_index", "slot").collect()
    labels: dict[str, list[str]] = {}
    for row in spark.read.schema(LABELS).parquet(f"{told['data']}/labels").orderBy("column", "position").collect():
        labels.setdefault(row["column"], []).append(row["value"])
    params = {k: tuple(v) if isinstance(v, list) else v for k, v in told["params"].items()}
    rows: dict[int, list[float]] = {}
    for row in weights:
        rows.setdefault(row["class_index"], []).append(row["weight"])
    model = LinearModel(ModelParams(**params), labels, [r[1:] for r in rows.values()], [r[0] for r in rows.values()])
    if [r["feature"] for r in weights if r["class_index"] == 0] != ["intercept", *model.slots]:
        raise ValueError("the weights and the labels of the model do not belong together")
    return model
