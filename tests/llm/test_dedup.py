"""Exact dedup, near dedup and long repeats against brute force."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from texts import awkward_texts, frame, prose

from seismerge.llm import near_dedup as N
from seismerge.llm import repeats as R
from seismerge.llm.components import connected_components
from seismerge.llm.exact_dedup import exact_dedup
from seismerge.llm.near_dedup import near_dedup
from seismerge.llm.repeats import SuffixIndex, remove_repeats


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def test_exact(spark, awkward):
    texts = awkward_texts()
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(t or "", []).append(i)
    got = {r.doc_id: r for r in exact_dedup(spark, awkward).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        own = groups[t or ""]
        assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (
            max(own), len(own), i == max(own), sha((t or "").encode()))


def test_exact_ties_and_null_ids(spark):
    rows = exact_dedup(spark, frame(spark, ["a", "a", "a", "b", "b"], [5, 5, None, None, None])).collect()
    assert sorted((r.keep_id or 0, r.group_size) for r in rows if r.kept) == [(0, 2), (5, 3)]


def test_exact_verifies_hashes(spark, monkeypatch):
    """With every chunk under one hash, contents still decide."""
    from pyspark.sql import functions as F

    from seismerge.llm import exact_dedup as X
    whole = X.chunks_of
    monkeypatch.setattr(X, "chunks_of", lambda *a: whole(*a).withColumn("h", F.when(F.col("pos").isNotNull(), F.lit(1).cast("long"))))
    texts = [prose(k % 7, 300) for k in range(20)]
    got = {r.doc_id: r.keep_id for r in X.exact_dedup(spark, frame(spark, texts)).collect()}
    assert got == {i: max(j for j in range(20) if j % 7 == i % 7) for i in range(20)}


def test_empty_tables(spark, empty):
    assert exact_dedup(spark, empty).count() == 0
    assert near_dedup(spark, empty).count() == 0
    assert remove_repeats(spark, empty).count() == 0


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        low = low.replace(blank, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_near(texts, ids):
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    low = {}
    for i in range(len(texts)):
        low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return {ids[i]: (len(sets[i]), low[find(i)]) for i in range(len(texts))}


def test_near_awkward(spark, awkward):
    texts = awkward_texts()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup(spark, awkward).collect()}
    assert got == brute_near(texts, range(len(texts)))


def chain(seed, n, words=200, step=6):
    """Texts that drift word by word: neighbours are near copies, far ones are not."""
    rng, w, out = random.Random(seed), prose(seed, words).split(), []
    for k in range(n):
        out.append(" ".join(w))
        at = rng.randrange(words - step)
        w[at:at + step] = [f"new{seed}n{k}n{i}" for i in range(step)]
    return out


@pytest.mark.parametrize("k,long", [(64, 512), (32, 100), (16, 220)])
def test_near_chains(spark, k, long):
    line = " ".join(f"common{i}" for i in range(60))
    texts = [t for s in range(4) for t in chain(s, 12)] + [f"{line} {prose(50 + i, 60)}" for i in range(40)]
    ids = list(range(len(texts)))
    random.Random(0).shuffle(ids)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup(spark, frame(spark, texts, ids), k=k, long=long).collect()}
    assert got == brute_near(texts, ids)


def test_near_truncated_copies_around_the_long_sketch(spark):
    """Sets of 430 to 520 shingles beside copies cut off at the threshold and just below it."""
    texts = []
    for n in range(430, 521, 5):
        for part, cut in enumerate((-(-85 * n // 100), 86 * n // 100 + 1, 85 * n // 100 - 1)):
            words = [f"w{n}p{part}i{i}" for i in range(n + 4)]
            texts += [" ".join(words), " ".join(words[:cut + 4])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup(spark, frame(spark, texts)).collect()}
    assert got == brute_near(texts, range(len(texts)))


def test_near_null_and_repeated_ids(spark):
    text = prose(1, 100)
    rows = near_dedup(spark, frame(spark, [text, text, text + " more", prose(2, 50)], [None, 3, 3, None])).collect()
    assert sorted((r.component_id or -1, r.kept) for r in rows) == [(-1, True), (3, False), (3, False), (3, True)]


def test_least_overlap():
    assert N.least_overlap(64, 85, 1e-9) < 0.85 * 64
    assert N.least_overlap(64, 85, 1e-9) <= N.least_overlap(64, 85, 1e-3)


def brute_repeats(texts):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for s in range(len(b) - 199):
            seen[b[s:s + 200]] = seen.get(b[s:s + 200], 0) + 1
    out = []
    for b in raw:
        mark = bytearray(len(b))
        for s in range(len(b) - 199):
            if seen[b[s:s + 200]] > 1:
                mark[s:s + 200] = b"\1" * 200
        kept = bytes(x for x, m in zip(b, mark) if not m)
        runs = sum(m and not p for m, p in zip(mark, b"\0" + mark))
        out.append((len(b), len(b) - len(kept), runs, sha(kept), kept))
    return out


@pytest.mark.parametrize("batches,small", [(1, 64), (2, 64), (5, 64), (2, 1)])
def test_repeats(spark, monkeypatch, batches, small):
    monkeypatch.setattr(R, "SMALL", small)
    rng = random.Random(3)
    pool = [prose(k, 60) for k in range(6)]
    texts = awkward_texts() + [prose(100 + i, 30) + " " + pool[rng.randrange(6)][rng.randrange(60):] + prose(200 + i, 30) for i in range(60)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept))
           for r in remove_repeats(spark, frame(spark, texts), batches=batches).collect()}
    want = brute_repeats(texts)
    assert [got[i] for i in range(len(texts))] == want


def test_index_levels(spark):
    index = SuffixIndex(spark)
    met = [sorted(r.core for r in index.add(spark.createDataFrame([(c,) for c in cores], "core long")).collect())
           for cores in ([1, 2, 2], [1, 5], [5, 6], [7, 6], [8])]
    assert met == [[2], [1, 2], [5], [1, 2, 5, 6], []] or [set(m) for m in met][3] >= {6}
    assert [size for size, _ in index.levels] == [4, 1]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 1), (50, 51), (51, 50)]
    got = {r.node: r.component for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 50: 50, 51: 50}


def test_sliding_min():
    rng = np.random.default_rng(0)
    for n, w in ((10, 3), (177, 177), (500, 177), (4, 1)):
        key = rng.integers(0, 1 << 63, n).astype(np.uint64)
        assert (R.sliding_min(key, w) == [key[i:i + w].min() for i in range(n - w + 1)]).all()


def test_entries_in_blocks(monkeypatch):
    text = prose(9, 3000).encode() + b"ab" * 500
    data, off = np.frombuffer(text, np.uint8), np.array([0, 150, 900, 900, len(text)])
    one = R.entries(data, off)
    monkeypatch.setattr(R, "_BLOCK", 333)
    two = R.entries(data, off)
    assert all((one[k] == two[k]).all() for k in one)


def test_documents_that_share_much_but_are_not_linked_form_few_pairs(spark, monkeypatch):
    """600 common and 90 own words: no two are linked (0.77), at any number."""
    counts = []
    whole = N.crossing_pairs
    monkeypatch.setattr(N, "crossing_pairs", lambda *a: (lambda d: (counts.append(d.count()), d)[1])(whole(*a)))
    common = prose(77, 600, 5000)
    for n in (50, 100, 200):
        docs = frame(spark, [common + " " + prose(1000 + k, 90, 100000) for k in range(n)])
        assert N.near_dedup(spark, docs).where("kept").count() == n
    assert counts[-1] <= 2 * counts[0] + 50


def test_a_hub_can_be_split(spark):
    """The join back of the star steps has plain exchanges on both sides."""
    edges = spark.range(1, 3000).selectExpr("0L as a", "id as b")
    got = connected_components(spark, edges)
    assert got.count() == 3000 and got.where("component <> 0").isEmpty()


@pytest.mark.parametrize("run", [N.sketcher(5, 64), N.full_sets(5)])
def test_few_texts_are_hashed_at_a_time(run):
    """Three workers of one executor share what its heap leaves."""
    texts = [prose(k, 300) for k in range(1000)]
    batch = pa.RecordBatch.from_pydict({"row": list(range(1000)), "doc_id": list(range(1000)), "text": texts})
    assert sum(map(len, texts)) > 1_500_000
    tracemalloc.start()
    rows = sum(b.num_rows for b in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1000 and peak < 30_000_000
