"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf; the leaves of a source, in order of their ids, are hashed
in runs of ``FANOUT`` until one node, the subroot, remains, and the subroots
likewise to the root. A node's label is (tree, level, place). Digests travel
as messages to their parent's label: within a block of leaves through a heap
ordered by label, from block to block through a written table that Spark's
external sort puts in order of the blocks. A second sweep runs over the same
labels in reverse: the root delivers the empty proof, and every parent hands
each child its siblings followed by its own proof.

No task holds more than a block (256 leaves and one message). A source
with a third of all rows is many blocks. Rounds grow with the logarithm of the
leaves to the base 256.

Defined results: a null field counts as ``-``; a null source is a source, the
first one; rows of a source with equal (or null, sorted first) ids are ordered
by their leaves; a null id is never tampered with; an empty table gives no
rows; extra columns are ignored; a text of any length is hashed whole.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.llm.common import numbered, written
from seismerge.llm.ordering import batched, grouped, ranked

FANOUT = 16
#: Levels of a tree that one block spans; it has FANOUT ** SPAN leaves at most.
SPAN = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "array<struct<before: string, after: string>>"
_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_table(docs: DataFrame, row: Column, tamper: Column) -> DataFrame:
    """row, doc_id, source, leaf, tampered (the leaf of the tampered row; null
    for rows left alone)."""
    def leaf(text: Column) -> Column:
        return F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)
    lower = F.translate(F.col("text"), UPPER, LOWER)
    return docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf(F.col("text")).alias("leaf"),
                       F.when(tamper, leaf(lower)).alias("tampered"))


def fold(leaf: str, path: list[dict]) -> str:
    """The root that ``leaf`` and its siblings, level by level, lead to."""
    for step in path:
        leaf = digest(step["before"] + leaf + step["after"])
    return leaf


def levels_of(size: int, span: int) -> int:
    """Levels that a block of a tree of ``size`` nodes has above them."""
    n = 0
    while size > 1 and n < span:
        size, n = -(-size // FANOUT), n + 1
    return n


def upward(digests: list[str], levels: int) -> list[list[str]]:
    """All nodes of a block, level by level. Messages (label of the receiver,
    place of the sender, digest) leave the heap in label order; a node is made
    once the next message is for another label."""
    nodes: list[list[str]] = [digests, *([] for _ in range(levels))]
    queue = [((1, i // FANOUT), i, d) for i, d in enumerate(digests)] if levels else []
    heapq.heapify(queue)
    while queue:
        label, run = queue[0][0], []
        while queue and queue[0][0] == label:
            run.append(heapq.heappop(queue)[2])
        level, place = label
        node = digest("".join(run))
        nodes[level].append(node)
        if level < levels:
            heapq.heappush(queue, ((level + 1, place // FANOUT), place, node))
    return nodes


def downward(nodes: list[list[str]], path: list[dict]) -> list[list[dict]]:
    """Each leaf's path to the root: the sweep in reverse label order, with the
    path of the block's top as its first message."""
    queue: list[tuple] = [((1 - len(nodes), 0), path)]
    out: list[list[dict]] = [[]] * len(nodes[0])
    while queue:
        (level, place), path = heapq.heappop(queue)
        if level == 0:
            out[place] = path
            continue
        first = place * FANOUT
        run = nodes[-level - 1][first:first + FANOUT]
        for i in range(len(run)):
            step = {"before": "".join(run[:i]), "after": "".join(run[i + 1:])}
            heapq.heappush(queue, ((level + 1, first + i), [step, *path]))
    return out


def climb(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """The top of every block, as a node of the next round."""
    def rows() -> Iterator[tuple]:
        for (tree, block), leaves in grouped(batches, ["tree", "block"]):
            size = leaves[0]["size"]
            top = upward([r["digest"] for r in leaves], levels_of(size, span))[-1][0]
            yield tree, block, top, -(-size // FANOUT ** span)
    yield from batched(rows(), pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("size", pa.int64())]))


def descend(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Paths of a block's leaves; its first row is the message to its top."""
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("path", _PATH), ("subroot", pa.string()), ("root", pa.string())])

    def rows() -> Iterator[tuple]:
        for (tree, _), (message, *leaves) in grouped(batches, ["tree", "block"]):
            nodes = upward([r["digest"] for r in leaves], levels_of(leaves[0]["size"], span))
            for r, path in zip(leaves, downward(nodes, message["path"])):
                yield tree, r["pos"], path, message["subroot"], message["root"]
    yield from batched(rows(), schema, 500)


def verify(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Like ``descend``, but with what a document's proof says."""
    def rows() -> Iterator[tuple]:
        for _, (message, *leaves) in grouped(batches, ["tree", "block"]):
            nodes = upward([r["digest"] for r in leaves], levels_of(leaves[0]["size"], span))
            for r, path in zip(leaves, downward(nodes, message["path"])):
                root = fold(r["tampered"] or r["digest"], path)
                proof = digest("".join(s["before"] + s["after"] for s in path))
                yield (r["row"], r["doc_id"], r["digest"], message["subroot"], message["root"], proof, root,
                       root == message["root"], path if message["keep"] else None)
    yield from batched(rows(), VERIFIED, 500)


VERIFIED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()),
                      ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()),
                      ("verified", pa.bool_()), ("path", _PATH)])
VERIFIED_DDL = ("row long, doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                f"folded_root string, verified boolean, path {PATH}")


def in_blocks(nodes: DataFrame, span: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {FANOUT ** span}"))


def by_label(nodes: DataFrame) -> DataFrame:
    """Blocks dealt over tasks, each in order of its labels."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def sweep_up(spark: SparkSession, leaves: DataFrame, span: int) -> tuple[list[DataFrame], DataFrame]:
    """From (tree, pos, digest, size): the nodes that each round starts from,
    and every tree's top (tree, digest)."""
    largest = leaves.agg(F.max("size")).first()[0] or 0
    rounds, level = [leaves], leaves
    while True:
        level = written(spark, by_label(in_blocks(level.select("tree", "pos", "digest", "size"), span)).mapInArrow(
            partial(climb, span=span), "tree string, pos long, digest string, size long"), "merkle-nodes")
        largest = -(-largest // FANOUT ** span)
        if largest <= 1:
            return rounds, level.select("tree", "digest")
        rounds.append(level)


def with_message(nodes: DataFrame, messages: DataFrame, span: int) -> DataFrame:
    """Nodes in label order behind the message to their block's top (place -1)."""
    return by_label(in_blocks(nodes, span).unionByName(messages.select(
        "tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "path", "subroot", "root", "keep"),
        allowMissingColumns=True))


def delivered(spark: SparkSession, nodes: DataFrame, messages: DataFrame, span: int) -> DataFrame:
    """The path of every node, with ``keep`` off."""
    return written(spark, with_message(nodes, messages, span).mapInArrow(
        partial(descend, span=span), f"tree string, pos long, path {PATH}, subroot string, root string"),
        "merkle-paths").withColumn("keep", F.lit(False))


def sweep_down(spark: SparkSession, rounds: list[DataFrame], messages: DataFrame, span: int) -> DataFrame:
    """Messages to the blocks of the first round's nodes, from those to the
    trees' tops (tree, pos = 0, path, subroot, root, keep)."""
    for nodes in reversed(rounds[1:]):
        messages = delivered(spark, nodes, messages, span)
    return messages


def merkle_manifest(spark: SparkSession, docs: DataFrame, tamper: Column | None = None,
                    keep_paths: bool = False, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """(sources, documents). Sources: source, subroot, root. Documents, one per
    row of ``docs``: row, doc_id, leaf, subroot, root, proof_sha256, folded_root
    (from the tampered row where ``tamper`` holds), verified, and the proof
    itself as ``path`` (a level's siblings before and after) if asked for."""
    tamper = F.lit(False) if tamper is None else F.coalesce(tamper, F.lit(False))
    leaves = written(spark, leaf_table(docs, numbered(spark), tamper), "merkle-leaves")
    # The label of a source's tree tells a null source from any other.
    leaves = written(spark, ranked(spark, leaves, "source", ["doc_id", "leaf", "row"])
                     .withColumn("tree", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")))
                     .withColumnRenamed("leaf", "digest").drop("source"), "merkle-ranked")
    rounds, tops = sweep_up(spark, leaves, span)
    tops = tops.withColumnRenamed("tree", "source")
    sources = written(spark, ranked(spark, tops.withColumn("all", F.lit("")), "all", ["source"])
                      .withColumnRenamed("all", "tree"), "merkle-sources")
    upper, root = sweep_up(spark, sources, span)
    start = root.select("tree", F.lit(0).cast("long").alias("pos"), F.array().cast(PATH).alias("path"),
                        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), F.lit(False).alias("keep"))
    paths = delivered(spark, sources, sweep_down(spark, upper, start, span), span)
    signed = written(spark, sources.join(paths.select("pos", "path", "root"), "pos").select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root",
        F.lit(False).alias("keep")), "merkle-signed")
    messages = sweep_down(spark, rounds, signed, span).withColumn("keep", F.lit(keep_paths))
    documents = with_message(leaves, messages, span).mapInArrow(partial(verify, span=span), VERIFIED_DDL)
    listed = signed.select(F.when(F.col("tree") != "-", F.expr("substring(tree, 2)")).alias("source"), "subroot", "root")
    return listed, documents
