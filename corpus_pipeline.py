"""The training-data pipeline over ``documents``: language ID, exact dedup, near
dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` (a table
that its predecessor wrote) and returns the rows that stay, with the columns
of documents; the last one returns the packed pieces. Decisions come from the
operators of ``seismerge.llm``; rows that go are few, so they are taken out
with an anti join on a row's position or id and texts move only if they must.

Defined results: a stage passes an empty table on as an empty table; rows with
a null id stay unless their text is rejected; further columns go along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.llm.common import numbered, written
from seismerge.llm.decontaminate import decontaminate
from seismerge.llm.exact_dedup import exact_dedup
from seismerge.llm.language import UNKNOWN, language_id
from seismerge.llm.near_dedup import near_dedup
from seismerge.llm.packing import pack

#: A language is rejected below this probability.
LEAST_SCORE = 0.5
#: Documents of this similarity (percent of shared five-word shingles) or more are near copies.
NEAR_PERCENT = 80


def without(spark: SparkSession, docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows at the positions ``gone(row)``. Positions are
    stable because ``docs`` is a plain table read."""
    at = next(n for n in ("row" + "_" * k for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    gone = written(spark, gone.select(F.col("row").alias(at)), "rejected")
    return docs.withColumn(at, numbered(spark)).join(gone, at, "left_anti").select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and those whose language stays unclear.
    Where no language could be learned (no label, or none outside the held-out
    rows), only texts without a letter go."""
    found = written(spark, language_id(spark, docs).select("row", "lang_pred", "score"), "languages")
    if found.where(F.col("lang_pred") != UNKNOWN).isEmpty():
        return without(spark, docs, docs.select(numbered(spark).alias("row"), F.col("text").cast("string").alias("text"))
                       .where(~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))))
    return without(spark, docs, found.where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < LEAST_SCORE)))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return without(spark, docs, exact_dedup(spark, docs).where("not kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (``NEAR_PERCENT``) stays."""
    return without(spark, docs, near_dedup(spark, docs, percent=NEAR_PERCENT).where("not kept"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    documents, _ = decontaminate(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(spark, docs, documents.where("contaminated"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of training sequences."""
    return pack(spark, docs)


STAGES = [("language ID", language_stage), ("exact dedup", exact_stage), ("near dedup", near_stage),
          ("decontamination", decontamination_stage), ("packing", packing_stage)]

#: Tokenizing and the trained language model are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(spark, docs, "stage")
    return docs
