"""The corpus pipeline: five stages on documents, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import decontaminate, jaccard_join, language_hd, mixing, pii_crf
from tallyforge.llm.storage import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told (null texts and texts without a letter) go, at any score; a missing label is filled in, if there are labels to learn from (all are used)."""
    known = language_hd.prototypes(docs)
    if not known:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language_hd.predictions(docs.select(F.struct("*").alias("row"), "text"), known).where(F.col("lang_pred") != language_hd.UNDETERMINED)
    return judged.select(F.col("row").withField("lang", F.coalesce("row.lang", "lang_pred")).alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return jaccard_join.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; all documents stay."""
    return pii_crf.masked(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it's taken, with ``copy`` from 1."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("mixing", mixing_sources),
]

#: Language prototypes, fitted models and hash orders are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
