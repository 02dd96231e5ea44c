"""The corpus pipeline: from ``documents`` to a mix for training.

Every stage takes ``(spark, docs, sf_dir)`` and works on all the stage before it kept; ``run`` writes each
result as Parquet in the shared folder and reads it back for the next one. Tables with null or empty
texts, repeated rows, no rows or more columns pass through as the operators describe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.jaccard import drop_near_copies
from basketry.llm.lines import drop_common_lines
from basketry.llm.mixing import mix_sources
from basketry.llm.templates import drop_contaminated
from basketry.llm.weak_labels import score_quality
from basketry.materialize import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return score_quality(docs, labels).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go; ``n_chars`` follows the text. Every document stays."""
    return drop_common_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or re-parameterised, go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document: ``taken`` words, repeats counted; documents it leaves out go."""
    return mix_sources(docs).where("taken > 0")


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", decontaminate),
    ("mix_sources", mix),
]

#: Fitting a classifier cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
