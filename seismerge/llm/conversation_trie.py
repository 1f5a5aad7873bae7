"""Prefix trie of conversations by union-find over sorted neighbours.

Conversations are sequences of turns; those with a common beginning share the
trie's nodes for it. Sorted, they lie side by side, and the trie is in the
numbers of turns that neighbours share: taking these edges in descending
depth, union-find merges the neighbours, and every merge makes (or widens) a
branching node at that depth, with the turns above the merged parts as chains
of single nodes. A partition of the sorted order gives a forest in this way.
Only nodes on the paths of its first and last sequence can reach over its
borders; the forest is contracted to those, and equal ones of all partitions
are merged. All other nodes are whole and written at once.

Sequences are cut into segments of ``SEGMENT`` turns, so that no row holds a
conversation of any length. A segment is sorted below the identity of what
came before it (the exclusive-or of its segments' hashes, each made with its
place), and segments are taken from the deepest shared one up: a segment's
trie hands its leaves and savings to the node it hangs from. A conversation
alone below some segment needs no trie there.

No task holds more than ``BLOCK`` segments, and no group is collected: a
group of equal conversations is one sequence with a count, counted before it
is moved. The digest of its members runs over their sorted ids in pieces of
``PIECE``; the hash itself is sequential, but reads the pieces as a stream.

Defined results: null role or text counts as empty; turns are ordered by turn
(null first), then role and the digest of role and text, and repeated rows are turns of their own;
rows with a null conv_id belong to no conversation; an empty table gives no
node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seismerge.llm.common import numbered, prepared, written
from seismerge.llm.ordering import batched, ranked

SEGMENT = 64
BLOCK = 4096
PIECE = 4096
#: Characters of a turn's identity: 128 bits of its SHA-256, in hexadecimal.
WIDE = 32
#: Turns that a conversation can take from another one, and how far apart those others are.
HEADS, EVERY = 4, 20
#: Segments whose identities are added up in one window.
CHAIN = 1024

WORD = r"[^\x20\x09-\x0D]+"
NONE = hashlib.sha256(b"").hexdigest()


def turns_of(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.select("conv_id", "turn", "role", "text", numbered(spark).alias("row")).where("conv_id is not null").select(
        "row", F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("tid"),
        F.regexp_count(text, F.lit(WORD)).alias("words"))


def rebuilt(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """conv, total (turns), depth, tid, words of the rebuilt conversations: the
    first h turns of conversation c - c % 20, then those of c after its first
    h, with h = crc32(c) % 4. Each also has a row of depth 0."""
    turns = written(spark, turns_of(spark, conversations), "turns")
    turns = written(spark, ranked(spark, turns, "conv", ["turn", "role", "tid", "row"]).select(
        "conv", (F.col("pos") + 1).alias("pos"), "size", F.substring("tid", 1, WIDE).alias("tid"), "words"), "turns-ranked")
    heads = (turns.where(F.col("pos") < HEADS).groupBy(F.col("conv").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "tid", "words"))).alias("heads")))
    h = (F.crc32(F.col("conv").cast("string")) % HEADS).cast("int")
    convs = turns.where("pos = 1").select("conv", "size", h.alias("h"), (F.col("conv") - F.col("conv") % EVERY).alias("base"))
    convs = convs.join(heads, "base", "left").withColumn(
        "heads", F.coalesce(F.slice("heads", F.lit(1), F.col("h")), F.expr("array()")))
    convs = written(spark, convs.select("conv", "h", "heads", (F.size("heads") - F.col("h")).alias("shift"),
                                        (F.size("heads") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("total")), "convs")
    own = (turns.select("conv", "pos", "tid", "words").join(convs.select("conv", "h", "shift", "total"), "conv").where("pos > h")
           .select("conv", "total", (F.col("pos") + F.col("shift")).alias("depth"), "tid", "words"))
    taken = convs.select("conv", "total", F.explode("heads").alias("t")).select(
        "conv", "total", F.col("t.pos").alias("depth"), "t.tid", "t.words")
    roots = convs.select("conv", "total", F.lit(0).cast("long").alias("depth"), F.lit("").alias("tid"), F.lit(0).alias("words"))
    return own.unionByName(taken).unionByName(roots)


def segments(spark: SparkSession, turns: DataFrame, segment: int, chain: int = CHAIN) -> DataFrame:
    """conv, k (the segment's number), seq (its turns' identities, joined),
    words (of each turn), p1, p2 (identity of what is before), f1, f2 (with
    this segment), ends (whether the conversation ends here)."""
    k = F.expr(f"greatest(depth - 1, 0) div {segment}")
    cut = (turns.groupBy("conv", "total", k.alias("k"))
           .agg(F.array_sort(F.collect_list(F.struct("depth", "tid", "words"))).alias("all"))
           .withColumn("all", F.filter("all", lambda t: t["depth"] > 0))
           .select("conv", "k", F.array_join("all.tid", "").alias("seq"), F.col("all.words").alias("words"),
                   (F.col("total") <= (F.col("k") + 1) * segment).alias("ends"), F.expr(f"k div {chain}").alias("chain")))
    sha = F.sha2(F.concat_ws(":", "k", "seq"), 256)
    cut = cut.select("*", *[F.conv(F.substring(sha, a, 15), 16, 10).cast("long").alias(c) for a, c in ((1, "h1"), (16, "h2"))])
    run = Window.partitionBy("conv", "chain").orderBy("k")
    cut = written(spark, cut.select("*", F.bit_xor("h1").over(run).alias("x1"), F.bit_xor("h2").over(run).alias("x2")), "segments")
    chains = cut.groupBy("conv", "chain").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.max("ends").alias("ends"))
    past = Window.partitionBy("conv").orderBy("chain").rowsBetween(Window.unboundedPreceding, -1)
    before = chains.where("chain > 0 or not ends").select(
        "conv", "chain", F.bit_xor("h1").over(past).alias("b1"), F.bit_xor("h2").over(past).alias("b2"))
    cut = cut.join(before, ["conv", "chain"], "left")
    full = [F.col(f"x{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0).cast("long"))) for i in (1, 2)]
    return cut.select("conv", "k", "seq", "words", "ends", *[full[i].bitwiseXOR(F.col(f"h{i + 1}")).alias(f"p{i + 1}") for i in (0, 1)],
                      *[full[i].alias(f"f{i + 1}") for i in (0, 1)])


class Forest:
    """Trie of consecutive sorted segments. A node is open if the segment
    ``first`` or ``last`` of the block is below it; its figures then cover
    this block's closed parts only."""

    def __init__(self) -> None:
        self.parent, self.depth, self.n, self.conv, self.kids = [], [], [], [], []
        self.leaves, self.saved, self.words, self.entry, self.open, self.sample = [], [], [], [], [], []

    def add(self, depth: int, sample: int, words: int) -> int:
        for column, value in ((self.parent, -1), (self.depth, depth), (self.n, 0), (self.conv, None), (self.kids, 0), (self.leaves, 0),
                              (self.saved, 0), (self.words, words), (self.entry, -1), (self.open, False), (self.sample, sample)):
            column.append(value)
        return len(self.depth) - 1

    def close(self, v: int) -> None:
        if not self.open[v]:
            self.leaves[v] = self.leaves[v] or 1
            self.saved[v] += (self.n[v] - 1) * self.words[v]

    def adopt(self, u: int, v: int) -> None:
        self.close(v)
        self.parent[v] = u
        self.n[u] += self.n[v]
        self.conv[u] = self.conv[v] if self.conv[u] is None else min(self.conv[u], self.conv[v])
        if self.open[v]:
            self.open[u] = True
        else:
            self.kids[u] += 1
            self.leaves[u] += self.leaves[v]
            self.saved[u] += self.saved[v]

    def build(self, rows: list[dict], first: int, last: int) -> None:
        """Union-find over the rows' neighbour edges in descending depth."""
        def raised(v: int, depth: int) -> int:
            while self.depth[v] > depth:
                d, s = self.depth[v] - 1, self.sample[v]
                u = self.add(d, s, rows[s]["words"][d - 1] if d else 0)
                self.adopt(u, v)
                v = u
            return v

        top, root = [], list(range(len(rows)))
        for i, r in enumerate(rows):
            d = len(r["words"])
            v = self.add(d, i, r["words"][-1] if d else 0)
            self.n[v], self.conv[v], self.kids[v], self.leaves[v], self.saved[v] = r["n"], r["conv"], r["kids"], r["leaves"], r["saved"]
            self.entry[v], self.open[v] = i, i in (first, last)
            top.append(v)

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        edges = [shared(a["seq"], b["seq"]) for a, b in zip(rows, rows[1:])]
        for e in sorted(range(len(edges)), key=lambda e: -edges[e]):
            depth, a, b = edges[e], find(e), find(e + 1)
            # What sorts behind the edge is always longer than it.
            low, high = raised(top[a], depth), raised(top[b], depth + 1)
            self.adopt(low, high)
            root[b], top[a] = a, low
        self.close(raised(top[find(0)], 0))


def shared(a: str, b: str) -> int:
    """Turns at the beginning that two sequences have in common."""
    n = min(len(a), len(b)) // WIDE
    for d in range(n):
        if a[d * WIDE:(d + 1) * WIDE] != b[d * WIDE:(d + 1) * WIDE]:
            return d
    return n


#: What became of a node: whole; whole, below an open node; open; the top of a segment's trie.
WHOLE, HANGING, OPEN, TOP = range(4)
NODE = pa.schema([("kind", pa.int32()), ("p1", pa.int64()), ("p2", pa.int64()), ("depth", pa.int32()), ("prefix", pa.string()),
                  ("conv", pa.int64()), ("parent", pa.int64()), ("n", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()),
                  ("saved", pa.int64()), ("words", pa.int32()), ("above", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                  ("n_ends", pa.int64()), ("end_conv", pa.int64())])
NODE_DDL = ("kind int, p1 long, p2 long, depth int, prefix string, conv long, parent long, n long, kids long, leaves long, "
            "saved long, words int, above long, f1 long, f2 long, n_ends long, end_conv long")


def block_nodes(rows: list[dict], at_root: bool) -> Iterator[tuple]:
    """The nodes of one block of sorted segments."""
    start = 0
    for end in range(1, len(rows) + 1):
        key = rows[start]["p1"], rows[start]["p2"]
        if end < len(rows) and key == (rows[end]["p1"], rows[end]["p2"]):
            continue
        run, t = rows[start:end], Forest()
        t.build(run, -start, len(rows) - 1 - start)
        above = run[0]["above"]
        for v, u in enumerate(t.parent):
            r = run[t.entry[v]] if t.entry[v] >= 0 else {}
            depth, hang, parent = t.depth[v], False, None
            if depth == 1 and not at_root:
                parent = above
            elif depth:
                hang = t.open[u]
                parent = None if hang else t.conv[u]
            if t.open[v]:
                kind, prefix = OPEN, run[t.sample[v]]["seq"][:depth * WIDE]
            elif not depth and not at_root:
                kind, prefix = TOP, None
            else:
                kind = HANGING if hang else WHOLE
                prefix = run[t.sample[v]]["seq"][:(depth - 1) * WIDE] if hang else None
            ends = r.get("n_ends") or 0
            yield (kind, *key, depth, prefix, t.conv[v], parent, t.n[v], t.kids[v], t.leaves[v], t.saved[v], t.words[v], above,
                   r["f1"] if ends else None, r["f2"] if ends else None, ends, r["end_conv"] if ends else None)
        start = end


def forests(batches: Iterator[pa.RecordBatch], at_root: bool, block: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == block:
                    yield from block_nodes(held, at_root)
                    held = []
        if held:
            yield from block_nodes(held, at_root)
    yield from batched(rows(), NODE)


def merged(spark: SparkSession, nodes: DataFrame, at_root: bool) -> DataFrame:
    """Open nodes of all blocks, merged by what they are: with their own part of
    the trie complete, and their subtrees' sums along the ancestors they have
    among each other."""
    key = ["p1", "p2", "depth", "prefix"]
    one = nodes.where(F.col("kind") == OPEN).groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")], F.min("conv").alias("conv"),
        *[F.max(c).alias(c) for c in ("words", "above", "f1", "f2", "n_ends", "end_conv")])
    one = written(spark, one, "trie-open")
    up = F.expr(f"substring(prefix, 1, (depth - 1) * {WIDE})")
    kids = one.where("depth > 0").groupBy("p1", "p2", (F.col("depth") - 1).alias("depth"), up.alias("prefix")).agg(
        F.count("*").alias("open_kids"))
    one = written(spark, one.join(kids, key, "left").withColumn("kids", F.col("kids") + F.coalesce("open_kids", F.lit(0)))
                  .drop("open_kids"), "trie-open")
    sums = one.select("p1", "p2", F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("depth"), "prefix",
                      F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).alias("leaves"),
                      (F.col("saved") + (F.col("n") - 1) * F.col("words")).alias("saved"))
    sums = (sums.withColumn("prefix", F.expr(f"substring(prefix, 1, depth * {WIDE})"))
            .groupBy(*key).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    above = one.select("p1", "p2", (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"), F.col("conv").alias("parent"))
    one = one.drop("leaves", "saved").join(sums, key).withColumn("up", F.when(F.col("depth") > 0, up))
    one = one.join(above, ["p1", "p2", "depth", "up"], "left").drop("up")
    if not at_root:
        one = one.withColumn("parent", F.when(F.col("depth") == 1, F.col("above")).otherwise(F.col("parent")))
    return written(spark, one, "trie-merged")


RESULT = ["conv", "depth", "parent", "n", "kids", "leaves", "saved", "f1", "f2", "n_ends", "end_conv"]


def level(spark: SparkSession, entries: DataFrame, k: int, segment: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of the segments number ``k``, and the sums of each of their tries."""
    keys = ["p1", "p2", "seq"]
    nodes = written(spark, written(spark, entries, "trie-segments").repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .mapInArrow(partial(forests, at_root=k == 0, block=block), NODE_DDL), "trie-nodes")
    opened = merged(spark, nodes, k == 0)
    whole = nodes.where(F.col("kind") == WHOLE).select(*RESULT)
    parents = opened.select("p1", "p2", (F.col("depth") + 1).alias("depth"), "prefix", F.col("conv").alias("parent"))
    hanging = nodes.where(F.col("kind") == HANGING).drop("parent").join(parents, ["p1", "p2", "depth", "prefix"]).select(*RESULT)
    tops = opened if k == 0 else opened.where("depth > 0")
    out = whole.unionByName(hanging).unionByName(tops.select(*RESULT)).withColumn("depth", F.col("depth") + k * segment)
    sums = ["p1", "p2", "kids", "leaves", "saved"]
    return out, nodes.where(F.col("kind") == TOP).select(*sums).unionByName(opened.where("depth = 0").select(*sums))


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (f1, f2, conv) as comma-joined ids of at most PIECE members."""
    def rows() -> Iterator[tuple]:
        key, ids = None, []
        for batch in batches:
            for k1, k2, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if key != (k1, k2) or len(ids) == PIECE:
                    if ids:
                        yield *key, ids[0], ",".join(map(str, ids))
                    key, ids = (k1, k2), []
                ids.append(conv)
        if ids:
            yield *key, ids[0], ",".join(map(str, ids))
    yield from batched(rows(), pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]), 50)


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each group's pieces, in order, as they come."""
    def rows() -> Iterator[tuple]:
        key, sha = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if key != (r["f1"], r["f2"]):
                    if sha:
                        yield *key, sha.hexdigest()
                    key, sha = (r["f1"], r["f2"]), hashlib.sha256(r["ids"].encode())
                else:
                    sha.update(b"," + r["ids"].encode())
        if sha:
            yield *key, sha.hexdigest()
    yield from batched(rows(), pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("sha", pa.string())]))


def end_digests(spark: SparkSession, cut: DataFrame, several: DataFrame) -> DataFrame:
    """f1, f2, sha of the members that end in each sequence of ``several``."""
    members = written(spark, cut.where("ends").select("f1", "f2", "conv").join(several, ["f1", "f2"], "left_semi"), "trie-ends")
    order = ["f1", "f2", "conv"]
    lists = written(spark, members.repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInArrow(pieces, "f1 long, f2 long, first long, ids string"), "trie-end-ids")
    return written(spark, lists.repartition("f1", "f2").sortWithinPartitions("f1", "f2", "first")
                   .mapInArrow(hashed, "f1 long, f2 long, sha string"), "trie-end-hashes")


def conversation_trie(spark: SparkSession, conversations: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, n_ends (members
    that end here)."""
    prepared(spark)
    cut = written(spark, segments(spark, rebuilt(spark, conversations), segment), "trie-cut")
    own = ["k", "p1", "p2"]
    entries = written(spark, cut.groupBy(*own, "seq").agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("words").alias("words"), F.first("f1").alias("f1"),
        F.first("f2").alias("f2"), F.count_if("ends").alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv"))).alias("end_conv")),
        "trie-entries")
    deeper = written(spark, entries.where("k > 0").groupBy(*own).agg(F.sum("n").alias("members")), "trie-groups")
    over = entries.where("n > n_ends").select((F.col("k") + 1).alias("k"), F.col("f1").alias("p1"), F.col("f2").alias("p2"),
                                              F.col("conv").alias("above"))
    lower = written(spark, entries.where("k > 0").join(deeper, own).join(over, own), "trie-lower")
    alone = lower.where("members = 1").select(
        "conv", F.posexplode("words").alias("at", "w"), "k", "above", (F.size("words") - 1).alias("last"), "n_ends", "f1", "f2").select(
        "conv", (F.col("k") * segment + F.col("at") + 1).alias("depth"),
        F.when(F.col("at") == 0, F.col("above")).otherwise(F.col("conv")).alias("parent"), F.lit(1).alias("n"),
        F.when((F.col("at") == F.col("last")) & (F.col("n_ends") > 0), 0).otherwise(1).alias("kids"), F.lit(1).alias("leaves"),
        F.lit(0).alias("saved"), "f1", "f2", F.when(F.col("at") == F.col("last"), F.col("n_ends")).otherwise(0).alias("n_ends"),
        F.col("conv").alias("end_conv"))
    single = deeper.where("members = 1").select(
        "k", F.col("p1").alias("f1"), F.col("p2").alias("f2"), *[F.lit(x).cast("long").alias(c) for c, x in (("kids", 1), ("leaves", 1), ("saved", 0))])
    deepest = deeper.where("members > 1").agg(F.max("k")).first()[0] or 0
    out, sums = alone, None
    for k in range(deepest, -1, -1):
        here = lower.where((F.col("k") == k) & (F.col("members") > 1)).drop("members") if k else (
            entries.where("k = 0").withColumn("above", F.lit(None).cast("long")))
        below = single.where(F.col("k") == k + 1).drop("k")
        if sums is not None:
            below = below.unionByName(sums.withColumnsRenamed({"p1": "f1", "p2": "f2"}))
        below = written(spark, below, "trie-below")
        here = here.join(below, ["f1", "f2"], "left").fillna(0, ["kids", "leaves", "saved"]).drop("k")
        nodes, sums = level(spark, here, k, segment, block)
        out = out.unionByName(nodes)
    shas = end_digests(spark, cut, written(spark, entries.where("n_ends > 1").select("f1", "f2"), "trie-several"))
    final = [F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"),
             *[F.col(a).cast("long").alias(b) for a, b in (("n", "n_convs"), ("kids", "n_children"), ("leaves", "n_leaves"), ("saved", "saved_tokens"))]]

    def result(nodes: DataFrame, ends: Column) -> DataFrame:
        return nodes.select(*final, ends.alias("ends_sha256"), F.col("n_ends").cast("long").alias("n_ends"))
    few = out.where("n_ends < 2")
    return result(few, F.when(F.col("n_ends") == 1, F.sha2(F.col("end_conv").cast("string"), 256)).otherwise(F.lit(NONE))).unionByName(
        result(out.where("n_ends > 1").join(shas, ["f1", "f2"]), F.col("sha")))
