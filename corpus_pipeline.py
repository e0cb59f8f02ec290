"""Training-data pipeline: documents -> quality -> near-dedup -> decontamination -> PII -> mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and reads it
again as the next stage's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import decontam, icws, pareto_mix, pii
from shelfcast.llm.compression_quality import METRICS, compression_quality
from shelfcast.session import scratch_dir, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands; null and wordless texts do not."""
    ship_package(spark)
    metrics = {name for name, _ in METRICS}
    aside = {c: f"__aside_{i}" for i, c in enumerate(docs.columns) if c.lower() in metrics}  # clashing names
    judged = compression_quality(docs.withColumnsRenamed(aside)).filter("kept")
    return judged.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies: the one with the smallest id."""
    ship_package(spark)
    return icws.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind's tag, n_chars as of the new text."""
    masked = pii.mask(pii.find_pii(docs, out="__pii"), spans_col="__pii")
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their number of copies and the words taken; texts of 100 to 1,000 words
    have twice the inclusion weight."""
    return pareto_mix.pareto_mix(docs, weight_col=pareto_mix.length_weight(pareto_mix.n_words(F.col("text")))).filter("copies > 0")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mask_pii", mask_pii),
          ("mix", mix)]

#: Compression ratios and consistent samples are not SQL: the pipeline is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_dir(spark, f"corpus-pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
