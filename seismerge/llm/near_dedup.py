"""Near-duplicate groups from bottom-k sketches of word shingles.

One hash function orders all shingles; a document's sketch is its ``k``
smallest shingle hashes. Documents with equal shingle sets are one node from
the start. Inverted lists of retained values say how many of a node's values
any other sketch holds; a node with too few of them can have no link and is
done, whatever its other values are. The nodes left over get longer sketches
(``LONG`` values; most of them are then whole sets) and lists again, now of
nodes: values are ordered rarest first and a node enters only the lists of
its rarest ones, so few that two linked nodes still must meet in one of them
(prefix filter: a shorter prefix as the smaller set of a pair, a longer one
as the larger). Pairs that meet in a list too late in either order to overlap
enough are not formed. The bottom-k of the union of two sketches estimates
their similarity and drops clear misses; the rest are confirmed on full sets.

Sketches of sets with at most k shingles are the sets themselves, so nothing
is estimated there. For longer ones the least overlap that still counts is
taken so low that a pair at the threshold falls below it with a probability
of at most ``MISS``.

Links are first sought in a star around each list's most central node (the
one with the fewest values of its own); linked nodes form components, and
after that only pairs whose ends are in different components are formed. A
group of thousands of near copies so costs one pair per member, not all its
pairs, and no link that would join two components is left out.

Defined results: words are runs of non-blank bytes, A-Z in lower case; a
document with fewer than ``SHINGLE`` words has its whole sequence as one
shingle; null, empty and blank texts have an empty set, a component of their
own and no links. Rows that repeat a doc_id are rows like any other; a null
id is never a component's smallest unless all are null. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.llm.common import byte_sums, lower_ascii, mix, numbered, released, slices, space_words, span_hash, with_columns, written
from seismerge.llm.components import connected_components

SHINGLE, SKETCH, LONG, PERCENT, MISS = 5, 64, 4096, 85, 1e-9
#: Text hashed at a time: every byte becomes some sixty bytes of arrays.
HASH_BYTES = 1 << 18
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int) -> list[np.ndarray]:
    """Per row the sorted distinct 63-bit hashes of its word shingles."""
    data = lower_ascii(data)
    start, end, first = space_words(data, off)
    words = span_hash(byte_sums(data), start, end)
    run = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for j in range(size):
        run = run * _STEP + words[j:j + len(run)]
    run = (mix(run) >> np.uint64(1)).astype(np.int64)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            out.append(np.unique(run[a:b - size + 1]))
        elif b > a:
            h = np.array([b - a], np.uint64)
            for w in words[a:b]:
                h = h * _STEP + w
            out.append((mix(h) >> np.uint64(1)).astype(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def least_overlap(k: int, percent: int, miss: float) -> int:
    """The largest m such that fewer than m of k draws at ``percent`` has at most
    the probability ``miss``."""
    if percent >= 100:
        return k
    p, total = percent / 100, 0.0
    for m in range(k + 1):
        choose = math.lgamma(k + 1) - math.lgamma(m + 1) - math.lgamma(k - m + 1)
        total += math.exp(choose + m * math.log(p) + (k - m) * math.log(1 - p))
        if total > miss:
            return m
    return k


def lists_of(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(s) for s in sets])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))


def node_ids(sets: list[np.ndarray]) -> pa.Array:
    """One 64-bit id for each distinct set."""
    sums = np.array([mix(s.astype(np.uint64)).sum(dtype=np.uint64) + np.uint64(len(s)) for s in sets], np.uint64)
    return pa.array(mix(sums).astype(np.int64))


def sketcher(size: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in slices(batches, limit=HASH_BYTES):
            sets = shingle_sets(data, off, size)
            yield with_columns(rows, ["row", "doc_id"], n=np.array([len(s) for s in sets], np.int64),
                               node=node_ids(sets), sketch=lists_of([s[:k] for s in sets]))
        released()
    return run


def full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in slices(batches, limit=HASH_BYTES):
            sets = shingle_sets(data, off, size)
            yield with_columns(rows, [], node=node_ids(sets), items=lists_of(sets))
        released()
    return run


def least_shared(n: Column, k: int, percent: int, miss: float, exact: Column) -> Column:
    """Values of a sketch that a linked partner's sketch must hold: ``exact``
    where both are whole sets; where either may be longer, no more than the
    estimate's lower bound, which holds only for unions of at least ``k``."""
    return F.when(n * 100 <= k * percent, exact).otherwise(
        F.least(exact, F.lit(least_overlap(k, percent, miss)))).cast("int")


def shared_values(spark: SparkSession, sketches: DataFrame, k: int, percent: int, miss: float) -> DataFrame:
    """(node, n, kept, need, shared) of nodes that may have a link; ``shared``
    are its values that occur in more than one sketch, rarest first."""
    values = sketches.where("n > 0").select("node", "n", F.explode("sketch").alias("value"))
    often = written(spark, values.groupBy("value").agg(F.count("*").alias("often")).where("often > 1"), "often")
    need = least_shared(F.col("n"), k, percent, miss, F.ceil(F.col("n") * percent / 100))
    return (values.join(often, "value").groupBy("node", "n")
            .agg(F.array_sort(F.collect_set(F.struct("often", "value"))).alias("shared"))
            .withColumn("kept", F.least(F.col("n"), F.lit(k)).cast("int")).withColumn("need", need)
            .where(F.size("shared") >= F.col("need")))


def prefix_lists(spark: SparkSession, sketches: DataFrame, k: int, percent: int, miss: float) -> DataFrame:
    """(value, node, n, own, at, index): the inverted lists of rarest values. A
    node's ``own`` values, those in no other sketch, come first in its order;
    ``at`` is a value's place in it; ``index``: also in the prefix that serves
    for partners at least as large."""
    equal = least_shared(F.col("n"), k, percent, miss, F.ceil(F.col("n") * (2 * percent) / (100 + percent)))
    rows = (shared_values(spark, sketches, k, percent, miss)
            .withColumn("own", F.col("kept") - F.size("shared")).withColumn("equal", equal)
            .select("node", "n", "own", "kept", "equal", F.posexplode(F.slice(
                "shared", 1, F.size("shared") - F.col("need") + 1)).alias("place", "v")))
    at = F.col("own") + F.col("place")
    return written(spark, rows.select(F.col("v.value").alias("value"), "node", "n", "own", at.alias("at"),
                                      (at <= F.col("kept") - F.col("equal")).alias("index")), "lists")


def star_pairs(spark: SparkSession, lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of each list's members with its most central one."""
    # A table of its own, as are the aggregates below: the join then has plain
    # exchanges on both sides, so that a value of very many nodes is split.
    centre = written(spark, lists.groupBy("value").agg(F.min(F.struct("own", "node")).alias("c")).select(
        "value", F.col("c.node").alias("centre")), "centres")
    return lists.join(centre, "value").where("node <> centre").select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def crossing_pairs(lists: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs of a list in different components that may still be linked: sizes
    close enough, and enough values left after the one they share. A node's own
    values come first in its order, so documents that have a third of their
    shingles in common, but not enough for a link, form no pairs."""
    x = lists.where("index").select("value", *[F.col(c).alias(c + "_x") for c in ("node", "n", "at", "component")])
    y = lists.select("value", *[F.col(c).alias(c + "_y") for c in ("node", "n", "at", "component")])
    left = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))
    exact = left * (100 + percent) >= (F.col("n_x") + F.col("n_y")) * percent
    enough = exact | (F.col("n_y") > k)  # longer sets: as far as their prefixes say
    return (x.join(y, ["value"]).where((F.col("component_x") != F.col("component_y")) & enough
                                       & (F.col("n_x") * 100 >= F.col("n_y") * percent)
                                       & ((F.col("n_x") < F.col("n_y"))
                                          | ((F.col("n_x") == F.col("n_y")) & (F.col("node_x") != F.col("node_y")))))
            .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct())


def links(spark: SparkSession, pairs: DataFrame, sets: DataFrame, k: int, percent: int, miss: float) -> DataFrame:
    """The linked pairs: estimated on union sketches, confirmed on full sets."""
    sketch = sets.select("node", F.size("items").alias("n"), F.slice("items", 1, k).alias("s"))
    both = (pairs.join(sketch.toDF("a", "na", "sa"), "a").join(sketch.toDF("b", "nb", "sb"), "b")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))
    bottom = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    same = F.size(F.array_intersect("sa", "sb"))
    whole = (F.col("na") <= k) & (F.col("nb") <= k)
    maybe = F.when(whole, same * 100 >= (F.col("na") + F.col("nb") - same) * percent).otherwise(
        F.size(F.array_intersect(bottom, F.array_intersect("sa", "sb"))) >= least_overlap(k, percent, miss))
    likely = written(spark, both.where(maybe).select("a", "b", whole.alias("whole")), "likely")
    inter = F.size(F.array_intersect("ia", "ib"))
    full = (likely.where("not whole").join(sets.toDF("a", "ia"), "a").join(sets.toDF("b", "ib"), "b")
            .where(inter * 100 >= (F.size("ia") + F.size("ib") - inter) * percent))
    return written(spark, likely.where("whole").select("a", "b").union(full.select("a", "b")), "links")


def near_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE, k: int = SKETCH, long: int = LONG, percent: int = PERCENT,
               miss: float = MISS) -> DataFrame:
    """row (the input's position), doc_id, n_shingles, component_id, kept:
    documents linked when 100 * intersection >= percent * union; the smallest
    id of a component stays, or of rows that share it the first."""
    texts = docs.select(numbered(spark).alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    sketches = written(spark, texts.mapInArrow(
        sketcher(shingle, k), "row long, doc_id long, n long, node long, sketch array<long>"), "sketches")
    maybe = written(spark, shared_values(spark, sketches, k, percent, miss).select("node"), "maybe")
    # One document stands for each node.
    stand = written(spark, sketches.join(maybe, "node", "left_semi").groupBy("node").agg(F.min("row").alias("row"))
                    .select("row"), "stand")
    sets = written(spark, texts.join(stand, "row", "left_semi").mapInArrow(
        full_sets(shingle), "node long, items array<long>"), "sets")
    lists = prefix_lists(spark, sets.select("node", F.size("items").cast("long").alias("n"),
                                            F.slice("items", 1, long).alias("sketch")), long, percent, miss)
    found = links(spark, written(spark, star_pairs(spark, lists), "pairs"), sets, long, percent, miss)
    classes = written(spark, connected_components(spark, found), "classes")
    grouped = lists.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = written(spark, grouped.groupBy("value").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                      .where("x <> y").select("value"), "several")
    still = written(spark, grouped.join(several, "value", "left_semi"), "open")
    more = links(spark, written(spark, crossing_pairs(still, long, percent), "pairs"), sets, long, percent, miss)
    classes = written(spark, connected_components(spark, found.union(more)), "classes")
    return labelled(spark, sketches, classes)


def labelled(spark: SparkSession, sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """Component labels back on all documents; an empty set stays by itself."""
    some = sketches.where("n > 0").select("row", "doc_id", "n", "node").join(classes, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    first = written(spark, some.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")), "firsts")
    rows = some.join(first, "component").select("row", "doc_id", "n", F.col("first.doc_id").alias("component_id"),
                                                (F.col("row") == F.col("first.row")).alias("kept"))
    alone = sketches.where("n = 0").select("row", "doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(True))
    return rows.union(alone).withColumnRenamed("n", "n_shingles")
