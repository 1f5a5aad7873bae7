"""Exact histogram of encoded lengths, and what follows from it.

Documents are encoded once and aggregated by length before the shuffle. Sums
over all longer documents then answer, for every context limit, how many
documents exceed it, how many tokens remain when documents are cut there, and
how many are lost. The running sums go block by block of lengths, so no task
holds more than one block or the list of blocks.

Defined results: a null or empty text has length 0; rows without an id count
like any other; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seismerge.llm.common import prepared, slices, written
from seismerge.llm.subwords import TOKENIZER, encoder

BLOCK = 4096


def lengths(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, off in slices(batches):
            _, bounds = encoder(tokenizer).encode(data, off)
            n, docs = np.unique(np.diff(bounds), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int64)), pa.array(docs.astype(np.int64))],
                                             names=["n_tokens", "docs"])
    return run


def token_histogram(spark: SparkSession, docs: DataFrame, text_col: str = "text",
                    tokenizer: str = TOKENIZER) -> DataFrame:
    """Per encoded length n_tokens: docs of that length, tokens in them;
    docs_ge and tokens_ge (this length or more); rank (documents shorter);
    truncated_tokens (all documents cut to n_tokens), lost_tokens."""
    prepared(spark)
    hist = written(spark, docs.select(F.col(text_col).alias("text")).mapInArrow(
        lengths(tokenizer), "n_tokens long, docs long").groupBy("n_tokens").agg(F.sum("docs").alias("docs")), "lengths")
    hist = hist.withColumn("tokens", F.col("n_tokens") * F.col("docs")).withColumn(
        "block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = hist.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(later), zero).alias("docs_after"),
                           F.coalesce(F.sum("t").over(later), zero).alias("tokens_after"),
                           F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("all_tokens"))
    within = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = hist.join(blocks, "block").select(
        "n_tokens", "docs", "tokens", (F.sum("docs").over(within) + F.col("docs_after")).alias("docs_ge"),
        (F.sum("tokens").over(within) + F.col("tokens_after")).alias("tokens_ge"), "all_docs", "all_tokens")
    cut = F.col("all_tokens") - F.col("tokens_ge") + F.col("docs_ge") * F.col("n_tokens")
    return out.select("n_tokens", "docs", "tokens", "docs_ge", "tokens_ge",
                      (F.col("all_docs") - F.col("docs_ge")).alias("rank"), cut.alias("truncated_tokens"),
                      (F.col("all_tokens") - cut).alias("lost_tokens"))


def totals_at(hist: DataFrame, limits: Sequence[int]) -> DataFrame:
    """limit, docs, tokens, truncated_tokens, docs_over: totals when documents
    are cut to each of the given context limits."""
    sums = hist.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"), *[
        F.sum(F.col("docs") * F.least("n_tokens", F.lit(x))).alias(f"cut{i}") for i, x in enumerate(limits)], *[
        F.sum(F.when(F.col("n_tokens") > x, F.col("docs")).otherwise(0)).alias(f"over{i}") for i, x in enumerate(limits)])
    return sums.select(F.inline(F.array(*[F.struct(
        F.lit(x).cast("long").alias("limit"), "docs", "tokens", F.col(f"cut{i}").alias("truncated_tokens"),
        F.col(f"over{i}").alias("docs_over")) for i, x in enumerate(limits)])))


def quantiles(hist: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """probability, n_tokens: the smallest length that at least this share of
    documents does not exceed."""
    reached = F.col("rank") + F.col("docs")
    total = F.col("rank") + F.col("docs_ge")
    low = hist.agg(*[F.min(F.when(reached >= F.ceil(total * p), F.col("n_tokens"))).alias(f"q{i}")
                     for i, p in enumerate(probabilities)])
    return low.select(F.inline(F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.col(f"q{i}").alias("n_tokens"))
                                         for i, p in enumerate(probabilities)])))
