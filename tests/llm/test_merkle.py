"""The Merkle manifest against a plain recursive statement of it."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from texts import SCHEMA, awkward_texts, frame

from seismerge.llm import merkle as M
from seismerge.llm.ordering import ranked
from seismerge.llm.queries import op12


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root, and for every leaf its (before, after) from its own level up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            a = i - i % 16
            path.append(("".join(nodes[a:i]), "".join(nodes[i + 1:a + 16])))
        at = [i // 16 for i in at]
        nodes = [sha("".join(nodes[a:a + 16])) for a in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    """{row number: result} of (doc_id, text, lang, source, n_chars) rows."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sources = {}
    for k, (i, text, lang, source, n) in enumerate(rows):
        sources.setdefault(source, []).append((i is not None, i, leaf_of((i, source, lang, n, text)), k))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    tops = {s: tree([x[2] for x in sorted(sources[s], key=lambda x: (x[0], x[1] or 0, x[2]))]) for s in order}
    root, upper = tree([tops[s][0] for s in order])
    out = {}
    for s, up in zip(order, upper):
        for (_, i, leaf, k), path in zip(sorted(sources[s], key=lambda x: (x[0], x[1] or 0, x[2])), tops[s][1]):
            path, (_, text, lang, source, n) = path + up, rows[k]
            folded = leaf
            if i is not None and zlib.crc32(str(i).encode()) % 5 == 0:
                folded = leaf_of((i, source, lang, n, None if text is None else text.translate(low)))
            for before, after in path:
                folded = sha(before + folded + after)
            out[k] = (i, leaf, tops[s][0], root, sha("".join(b + a for b, a in path)), folded, folded == root)
    return out


def check(spark, rows, **options):
    data = [(i, t, g, s, n, 7, "w", "x", "k", "h", 1, "q") for i, t, g, s, n in rows]
    docs = spark.createDataFrame(data, SCHEMA)
    id_ = F.col("doc_id").cast("string")
    _, got = M.merkle_manifest(spark, docs, F.crc32(id_) % 5 == 0, **options)
    got = sorted(tuple(r) for r in got.drop("row", "path").collect())
    want = sorted(brute(rows).values(), key=lambda r: tuple(r))
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("sizes", [[1], [16], [17], [256, 1], [257, 16, 3], [700, 1, 1, 1, 40], [2] * 20])
def test_sizes(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = [(0, f"T{s} {k}", "de" if k % 3 else None, f"S{s}", k) for s, n in enumerate(sizes) for k in range(n)]
    ids = rng.sample(range(-5000, 5000), len(rows))
    rows = [(i, *r[1:]) for i, r in zip(ids, rows)]
    rng.shuffle(rows)
    check(spark, rows)


@pytest.mark.parametrize("span", [1, 3])
def test_blocks_of_any_height(spark, span):
    check(spark, [(i, "aB" * (i % 5), None, "s" if i % 40 else None, i) for i in range(1, 500)], span=span)


def test_null_and_awkward_rows(spark):
    texts = awkward_texts()
    rows = [(i, t, None if i % 2 else "en", [None, "", "-", "ä", "z"][i % 5], None if i % 3 else i) for i, t in enumerate(texts)]
    check(spark, rows)


def test_ties_repeated_and_null_ids(spark):
    """Rows with equal or null ids go by their leaves; equal rows are equal leaves."""
    rows = [(i, t, None, "s", 1) for i, t in [(5, "B"), (5, "A"), (5, "A"), (5, None)] * 9] + [(5, "C", None, None, 1)] * 20
    check(spark, rows)
    _, got = M.merkle_manifest(spark, frame(spark, ["A"] * 40, [None] * 40), F.lit(None).cast("boolean"))
    assert {(r.doc_id, r.verified) for r in got.collect()} == {(None, True)}


def test_empty_table(spark, empty):
    sources, documents = M.merkle_manifest(spark, empty)
    assert sources.count() == 0 and documents.count() == 0


def test_proofs_lead_to_the_root(spark, awkward):
    sources, documents = M.merkle_manifest(spark, awkward, keep_paths=True)
    (top,) = sources.collect()
    for r in documents.collect():
        assert M.fold(r.leaf, r.path) == r.root == top.root
        assert M.fold(sha("other"), r.path) != r.root
        assert r.proof_sha256 == sha("".join(s.before + s.after for s in r.path))


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in op12(spark, sf_dir).collect()}
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got == {v[0]: v for v in brute(rows).values()}
    assert {v[-1] for v in got.values()} == {True, False}


def test_ranked_splits_a_hot_group(spark):
    from seismerge.llm.common import written
    rows = [("hot", k) for k in range(3000)] + [(None, k) for k in range(7)] + [("b", 1)]
    random.Random(1).shuffle(rows)
    got = ranked(spark, written(spark, spark.createDataFrame(rows, "g string, k long").repartition(5), "t"), "g", ["k"]).collect()
    assert all(r.pos == (r.k if r.g != "b" else 0) and r.size == {"hot": 3000, None: 7, "b": 1}[r.g] for r in got)
    assert len(got) == len(rows)
