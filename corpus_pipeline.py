"""A corpus pipeline of five operators: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.common import discard, others, quoted, saved
from labelloom.llm.decontam import drop_contaminated
from labelloom.llm.exact_dedup import drop_duplicates
from labelloom.llm.mixing import mix
from labelloom.llm.simhash import drop_near_duplicates
from labelloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that it rejects go. Columns are those of docs, as they are."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group of equal texts stays. Columns are those of docs, as they are."""
    return drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group stays. Columns are those of docs, as they are."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that contain a benchmark item go. Columns are those of docs, as they are."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: a row for each copy of a document that the mix takes, with its shard and its place there, in which order to read it. Columns of docs named like the seven new ones are replaced."""
    mixed = mix(docs.select(*map(quoted, others(docs, "shard", "pass", "words", "place"))))
    return mixed.select(*[quoted(c) for c in mixed.columns if c not in ("taken", "draws")], F.inline("draws"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("simhash_near_dedup", near), ("decontamination", decontaminate), ("mixing", mixture)]

#: Fitted models and near-duplicate components have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over documents, written as Parquet and read again in between."""
    docs, made = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
        if made is not None:
            discard(made)
        made = docs
    return STAGES[-1][1](spark, docs, sf_dir)
