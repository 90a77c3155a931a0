"""A training corpus from raw documents: five stages, each an operator of ``tallyframe.llm``.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps with their columns, texts
changed where the stage changes texts; the last returns the mix. Between stages the documents are
written and read again, so that a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate, lines, minhash, mixing, toxicity
from tallyframe.llm.learning import in_fold
from tallyframe.llm.staging import Workspace, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold, by what the labels outside the held-out fold teach."""
    labels = table(spark, sf_dir, "labels", ["doc_id", "toxic"]).where(~in_fold(F.col("doc_id"), 3, 1))
    return toxicity.without_toxic(docs, toxicity.learn_lexicon(docs, labels))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that more than a twentieth of their source's documents have, and three at least."""
    return lines.lines_deduplicated(docs, lines.SOURCE_RATIO)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Learned scores, weighted sampling and balanced sampling have no SQL; tests/llm/test_pipeline.py has their brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = work.keep(stage(spark, docs, sf_dir))
        if name != STAGES[0][0]:
            work.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
