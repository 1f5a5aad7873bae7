"""Exact dedup by content-defined chunk recipes, in DataFrame operations.

A text is cut where its own content says so (after a line end or a sentence
end, once a chunk has ``MIN_CHUNK`` characters; at ``MAX_CHUNK`` at the
latest), so equal texts get equal chunks. A chunk's identifier is its 64-bit
hash, verified: all distinct chunk contents are grouped by hash once, and for
a hash that stands for two contents the identifier holds the content itself.
A document is then its ordered list of identifiers; documents are equal when
their lists are. Long texts are moved once, as distinct chunks; lists, not
texts, are grouped and joined.

Defined results: a null text counts as empty, empty texts are equal to one
another, of rows with equal text and equal (largest) id one stays, a null id
is smaller than any other, extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.llm.common import numbered, written

MIN_CHUNK, MAX_CHUNK = 400, 4000
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 1}}}?(?:\n|[.!?] )|.{{1,{MAX_CHUNK}}}"


def chunks_of(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, doc_id, text_sha256, pos, chunk; a text without a chunk gives one row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(numbered(spark).alias("row"), F.col(id_col).alias("doc_id"),
                        F.unhex(F.sha2(text, 256)).alias("sha"),
                        F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0)).alias("chunks"))
            .select("row", "doc_id", "sha", F.posexplode_outer("chunks").alias("pos", "chunk"))
            .withColumn("h", F.xxhash64("chunk")))


def exact_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: row (the input's monotonic id), doc_id, keep_id,
    group_size, kept, text_sha256. The row with the largest id of each group
    of equal texts stays."""
    chunks = chunks_of(spark, docs, id_col, text_col)
    doubtful = written(spark, chunks.where("pos is not null").select("h", "chunk").distinct().groupBy("h").count()
                       .where("count > 1").select("h", F.lit(True).alias("doubt")), "chunk-hashes")
    recipes = (chunks.join(doubtful, "h", "left")
               .groupBy("row", "doc_id", "sha")
               .agg(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct(
                   "pos", "h", F.when(F.col("doubt"), F.col("chunk")).alias("content")))).alias("r"))
               .withColumn("recipe", F.transform(F.array_sort("r"), lambda c: F.struct(c["h"], c["content"])))
               .select("row", "doc_id", "sha", "recipe", F.xxhash64("recipe").alias("rh")))
    recipes = written(spark, recipes, "recipes")
    # A table of its own: the join below then has plain exchanges on both sides,
    # so that a list shared by very many documents is split over tasks.
    groups = written(spark, recipes.groupBy("rh", "recipe").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("keep")), "groups")
    return recipes.join(groups, ["rh", "recipe"]).select(
        "row", "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
