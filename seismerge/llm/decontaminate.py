"""Benchmark decontamination by winnowing, in DataFrame or SQL functions.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item
is one window of its own length L). Every L-word window is represented by the
smallest hash among its k-word grams (k = min(``GRAM``, L)): winnowing with
windows of L - k + 1 grams. A document's window can only equal an item's if
both have the same minimum, so a shared span of L words always shares a kept
fingerprint. Document fingerprints are joined with the benchmark's; each hit
is extended to its whole window and compared word for word, and overlapping
windows form the hit span.

The benchmark's distinct fingerprints are broadcast only up to
``BROADCAST_FINGERPRINTS`` rows (16 bytes each); beyond that, fingerprints of
documents are shuffled and joined, and only windows of matching documents are
built.

Defined results: null and empty texts have no words and no hits; an item
without words has no window; null item ids mark words but are not listed;
repeated items list once; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seismerge.llm.common import numbered, written

WINDOW, GRAM = 10, 5
BROADCAST_FINGERPRINTS = 1_000_000
#: Outside [\x00-\x2F\x3A-\x60\x7B-\x7F]; written as what it holds once A-Z are gone,
#: which Java's matcher takes far faster than the negated class.
WORD = r"[0-9a-z\x80-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """A-Z lower-cased, then runs of digits, letters and non-ASCII characters."""
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def grams(words: Column, k: int) -> Column:
    """Hashes of the k-word grams at positions 0 .. size - k."""
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(0), F.size(words) - k),
        lambda i: F.xxhash64(*[F.get(words, i + j if j else i) for j in range(k)]))).otherwise(
        F.array().cast("array<bigint>"))


def minima(hashes: Column, w: int) -> Column:
    """The smallest of each w consecutive hashes, one per window."""
    if w == 1:
        return hashes
    return F.when(F.size(hashes) >= w, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - w),
        lambda i: F.least(*[F.get(hashes, i + j if j else i) for j in range(w)]))).otherwise(
        F.array().cast("array<bigint>"))


def fingerprints(df: DataFrame, length: int) -> DataFrame:
    """``df(words)`` with ``mins``: the fingerprint of each ``length``-word window."""
    k = min(GRAM, length)
    return df.withColumn("grams", grams(F.col("words"), k)).withColumn(
        "mins", minima(F.col("grams"), length - k + 1)).drop("grams")


def window_text(i: Column, length: int) -> Column:
    return F.concat_ws(" ", F.slice("words", i + 1, length))


def candidates(spark: SparkSession, docs: DataFrame, prints: DataFrame, length: int, broadcast: int) -> DataFrame:
    """(row, i, window) of the document windows that share a fingerprint;
    ``docs(row, words)``, ``prints(fp)``. The outer forms of explode keep the
    optimizer from copying the fingerprint expression into a filter."""
    marked = fingerprints(docs, length)
    if prints.count() <= broadcast:
        return (marked.select("row", "words", F.posexplode_outer("mins").alias("i", "fp"))
                .join(F.broadcast(prints), "fp", "left_semi")
                .select("row", "i", window_text(F.col("i"), length).alias("window")))
    shared = (marked.select("row", F.explode_outer(F.array_distinct("mins")).alias("fp"))
              .join(prints, "fp", "left_semi").groupBy("row").agg(F.collect_list("fp").alias("fps")))
    shared = written(spark, shared, "shared-prints")
    at = F.filter(F.transform("mins", lambda m, i: F.when(F.array_contains("fps", m), i)), lambda i: i.isNotNull())
    return (fingerprints(docs.join(shared, "row"), length)
            .select("row", "words", F.explode_outer(at).alias("i")).where("i is not null")
            .select("row", "i", window_text(F.col("i"), length).alias("window")))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, broadcast: int = BROADCAST_FINGERPRINTS) -> tuple[DataFrame, DataFrame]:
    """(documents, spans).

    documents: one row per input row with row (its monotonic id), doc_id,
    n_words, n_hit, n_items, items_sha256, contaminated. spans: row, start,
    end, the word ranges of windows that occur (they may overlap)."""
    items = (benchmark.select(F.col(item_col).cast("string").alias("item_id"),
                              words_of(F.col(item_text_col)).alias("words"))
             .where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window))))
    items = written(spark, items, "items")
    rows = docs.select(numbered(spark).alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    words = rows.select("row", words_of(F.col("text")).alias("words"))
    found = None
    for (length,) in items.select("length").distinct().collect():  # at most ``window`` values
        own = (fingerprints(items.where(F.col("length") == length), length)
               .select("item_id", "words", F.posexplode_outer("mins").alias("i", "fp"))
               .select("item_id", "fp", window_text(F.col("i"), length).alias("window")).distinct())
        own = written(spark, own, "item-windows")
        prints = written(spark, own.select("fp").distinct(), "item-prints")
        cand = candidates(spark, words, prints, length, broadcast)
        part = (cand.join(own.select("window").distinct(), "window", "left_semi")
                .select("row", F.col("i").alias("start"), (F.col("i") + length).alias("end"), "window"))
        part = written(spark, part, "hits")
        named = (part.select("row", "window").distinct().join(own.select("window", "item_id"), "window")
                 .select("row", "item_id").distinct())
        found = (part, named) if found is None else (found[0].union(part), found[1].union(named))
    counts = rows.select("row", "doc_id", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    none = F.sha2(F.lit(""), 256)
    if found is None:
        return (counts.select("*", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                              none.alias("items_sha256"), F.lit(False).alias("contaminated")),
                counts.where("false").select("row", F.lit(0).alias("start"), F.lit(0).alias("end")))
    spans = found[0].select("row", "start", "end").distinct()
    before = F.max("end").over(Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    hits = (spans.withColumn("before", F.coalesce(before, F.col("start")))
            .groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before")))
                                .cast("long").alias("n_hit")))
    named = (found[1].groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
             .select("row", F.size("ids").cast("long").alias("n_items"),
                     F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")))
    result = counts.join(hits, "row", "left").join(named, "row", "left").select(
        "row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
    return result, spans
