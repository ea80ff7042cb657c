"""The corpus pipeline: five stages, each written as Parquet and reread.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from horavento.llm import decontaminate, line_dedup, near_dedup, packing, quality
from horavento.llm.common import table
from horavento.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surplus lines are cut out; a document that had text and is left with
    none goes.  ``n_chars``, where present, follows the text."""
    rows = line_dedup.dedup_lines(docs)
    blank = F.coalesce(F.col("text").rlike(r"^\s*$"), F.lit(True))
    rows = rows.where((F.col("n_dropped") == 0) | ~blank).drop("n_lines", "n_dropped")
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        rows = rows.withColumn("n_chars", F.length("text").cast(kind))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and batches of what is left."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage),
    ("packing", packing_stage),
]

#: classifier, MinHash candidates and packing are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
