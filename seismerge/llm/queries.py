"""The thirteen registered operator queries, and the pipeline, with their DuckDB
statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from seismerge.llm import oracle
from seismerge.llm.common import id_mod
from seismerge.llm.conversation_trie import conversation_trie
from seismerge.llm.decontaminate import decontaminate
from seismerge.llm.exact_dedup import exact_dedup
from seismerge.llm.license_scan import license_scan
from seismerge.llm.url_filter import url_filter

from seismerge.llm.near_dedup import near_dedup

from seismerge.llm.packing import pack

from seismerge.llm.token_counts import token_histogram

from seismerge.llm.language import language_id

from seismerge.llm.quality import quality_scores

from seismerge.llm.repeats import remove_repeats

from seismerge.llm.lm_score import lm_scores

from seismerge.llm.merkle import merkle_manifest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark, table(spark, sf_dir, "pages"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return documents.drop("row")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents")).drop("row")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark, table(spark, sf_dir, "documents")).drop("row")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_histogram(spark, table(spark, sf_dir, "documents"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(spark, table(spark, sf_dir, "documents")).drop("row")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, table(spark, sf_dir, "documents"), keep_text=False).drop("row", "kept")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark, table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(spark, table(spark, sf_dir, "documents")).drop("row", "detections")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, documents = merkle_manifest(spark, table(spark, sf_dir, "documents"), id_mod(F.col("doc_id"), 5) == 0)
    return documents.drop("row", "path")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark, table(spark, sf_dir, "conversations")).drop("n_ends")


REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_url_filter": (op1, oracle.URL_FILTER),
    "op4_decontamination": (op4, oracle.DECONTAMINATION),
    "op7_exact_dedup": (op7, oracle.EXACT_DEDUP),
    "op6_near_dedup": (op6, oracle.NEAR_DEDUP),
    "op5_packing": (op5, None),
    "op9_token_counts": (op9, None),
    "op2_language_id": (op2, None),
    "op10_quality": (op10, None),
    "op8_repeats": (op8, None),
    "op3_lm_score": (op3, None),
    "op11_license_scan": (op11, None),
    "op12_merkle_manifest": (op12, oracle.MERKLE_MANIFEST),
    "op13_conversation_trie": (op13, oracle.CONVERSATION_TRIE),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
