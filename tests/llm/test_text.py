"""URL filter, decontamination, packing, token counts and the trained models."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import awkward_texts, frame, prose

from seismerge.llm.attention import TRAINED, Adam, Attention
from seismerge.llm.decontaminate import decontaminate
from seismerge.llm.language import UNKNOWN, language_id
from seismerge.llm.lm_score import lm_scores
from seismerge.llm.packing import pack, sum_of_squares
from seismerge.llm.quality import quality_scores
from seismerge.llm.subwords import WordEncoder
from seismerge.llm.token_counts import quantiles, token_histogram, totals_at
from seismerge.llm.url_filter import url_filter

SMALL = "/root/testdata/sf0.001"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def canonical(url):
    return f'<html><head><LINK rel="canonical" href="{url}"></head></html>'


def test_url_filter(spark):
    rows = [(1, "http://a.example.org/es/x", None), (2, "http://a.example.org/en/12", ""), (3, "https://ORG/", "x"),
            (4, "http://x.net/alias", canonical("http://b.com/de/1")), (5, "http://x.net/alias#top", None),
            (6, "http://b.com/de/1", None), (7, "http://c.com/fr/9", canonical("http://b.com/de/1")),
            (8, None, canonical("http://b.com/de/1")), (9, "no url", None), (10, "http://notexample.org/es/", None),
            (11, "http://x.net/y", '<meta http-equiv="refresh" content="0; url=/alias">'), (12, "http://x.net/z", None),
            (13, "http://example.org", None), (14, "HTTP://W.COM/fr/?q", None), (15, "http://w.com/FR/", None), (1, "http://q.net", "")]
    pages = spark.createDataFrame([(*r, "n", "h") for r in rows], "page_id long, url string, html string, node string, host string")
    got = {(r.page_id, r.host): (r.path, r.rule, r.verdict) for r in url_filter(spark, pages).collect()}
    assert got == {
        (1, "a.example.org"): ("/es/x", "example.org/es/", "block"), (2, "a.example.org"): ("/en/12", "example.org/en/1", "block"),
        (3, "org"): ("/", "org/", "allow"), (4, "x.net"): ("/alias", None, "block"), (5, "x.net"): ("/alias", None, "block"),
        (6, "b.com"): ("/de/1", "com/de/", "block"), (7, "c.com"): ("/fr/9", "com/fr/", "allow"), (8, ""): ("", None, "allow"),
        (9, ""): ("", None, "allow"), (10, "notexample.org"): ("/es/", "org/", "allow"), (11, "x.net"): ("/y", None, "block"),
        (12, "x.net"): ("/z", None, "allow"), (13, "example.org"): ("", None, "allow"), (14, "w.com"): ("/fr/", "com/fr/", "allow"),
        (15, "w.com"): ("/FR/", None, "allow"), (1, "q.net"): ("", None, "allow")}
    # Redirects given as a table, through a url that is no page.
    more = spark.createDataFrame([("http://x.net/z", "http://hop.net/"), ("http://hop.net/", "http://k.com/de/")], "a string, b string")
    assert {r.page_id: r.verdict for r in url_filter(spark, pages, more).collect()}[12] == "block"
    assert url_filter(spark, pages.limit(0)).count() == 0


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def brute_hits(text, items):
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                if item is not None:
                    ids.add(str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_decontaminate(spark, broadcast):
    long, short = prose(7, 40), "Short item here"
    items = [(1, long), (2, prose(8, 10)), (10, short), (3, None), (4, ""), (5, prose(9, 11) + " " + long), (None, prose(11, 12)),
             (2, prose(8, 10)), (6, "... !!!"), (7, "a b c d e f")]
    texts = awkward_texts() + [long, prose(70, 50) + " " + long.upper().replace(" ", ", "), " ".join(long.split()[5:14]),
                               " ".join(long.split()[5:15]), "x short ITEM here, short item here", prose(8, 10), prose(8, 9),
                               prose(11, 12), "a b c d e f a b c d e f", "w1x " * 30, (prose(9, 11) + " ") * 3]
    bench = spark.createDataFrame([(i, t, "w") for i, t in items], "item_id long, text string, words string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in decontaminate(spark, frame(spark, texts), bench, broadcast=broadcast)[0].collect()}
    assert [got[i] for i in range(len(texts))] == [brute_hits(t, items) for t in texts]


def test_decontaminate_empty(spark, awkward, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate(spark, awkward, bench)[0].collect()
    assert len(rows) == len(awkward_texts()) and not any(r.contaminated for r in rows)
    assert decontaminate(spark, empty, bench)[0].count() == 0
    assert decontaminate(spark, empty, bench.union(spark.createDataFrame([(1, "a b")], bench.schema)))[0].count() == 0


def test_word_encoder():
    enc, texts = WordEncoder(), [t or "" for t in awkward_texts()] + ["Don't, it's. A.B,c é,d ,x. …,", "é, É.", "1,2.3"]
    raw = [t.encode() for t in texts]
    ids, bounds = enc.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(b) for b in raw]))
    for k, t in enumerate(texts):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("length,bucket", [(2048, 16384), (64, 10)])
def test_pack(spark, awkward, length, bucket):
    tok = WordEncoder().tokenizer
    rows = pack(spark, awkward, length=length, bucket=bucket).collect()
    by = {(r.doc_id, r.piece): r for r in rows}
    n = 0
    for i, t in enumerate(awkward_texts()):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), length)):
            part = ids[a:a + length]
            r = by[(i, k)]
            assert (r.start, r.length, r.ids_crc32) == (a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            n += 1
    assert n == len(rows)
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= length


def test_pack_empty(spark, empty):
    assert pack(spark, empty).count() == 0


def test_sum_of_squares_rule():
    """Each choice has the least sum of squared counts over gaps of open sequences."""
    rng, cap = random.Random(1), 20
    sizes = [rng.randint(1, cap) for _ in range(200)]
    where, offset = sum_of_squares(np.array(sizes), cap)
    gap = {}
    for s, w, o in zip(sizes, where.tolist(), offset.tolist()):
        def cost(gaps):
            return sum(n * n for g, n in Counter(gaps).items() if g)
        options = [cost([g - s if b == x else g for b, g in gap.items()]) for x in gap if gap[x] >= s] + [cost([*gap.values(), cap - s])]
        assert o == cap - gap.get(w, cap)
        gap[w] = gap.get(w, cap) - s
        assert gap[w] >= 0 and cost(gap.values()) == min(options)


def test_token_counts(spark, awkward, empty, monkeypatch):
    from seismerge.llm import token_counts
    monkeypatch.setattr(token_counts, "BLOCK", 16)
    tok = WordEncoder().tokenizer
    n = sorted(len(tok.encode(t or "", add_special_tokens=False).ids) for t in awkward_texts())
    hist = token_histogram(spark, awkward)
    rows = {r.n_tokens: r for r in hist.collect()}
    assert {k: r.docs for k, r in rows.items()} == dict(Counter(n))
    for k, r in rows.items():
        assert (r.docs_ge, r.tokens_ge, r.rank) == (sum(x >= k for x in n), sum(x for x in n if x >= k), sum(x < k for x in n))
        assert r.truncated_tokens == sum(min(x, k) for x in n) and r.lost_tokens == sum(max(0, x - k) for x in n)
    for r in totals_at(hist, [0, 1, 7, 100, 10 ** 6]).collect():
        assert (r.docs, r.tokens, r.truncated_tokens, r.docs_over) == (
            len(n), sum(n), sum(min(x, r.limit) for x in n), sum(x > r.limit for x in n))
    for r in quantiles(hist, [0.1, 0.5, 0.9, 1.0]).collect():
        assert r.n_tokens == n[int(np.ceil(len(n) * r.probability)) - 1]
    assert token_histogram(spark, empty).count() == 0


def held(i, n, rest):
    return zlib.crc32(str(i).encode()) % n == rest


def test_language(spark, awkward, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_id(spark, docs).collect()
    assert len(rows) == len(truth) and all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 for r in rows)
    apart = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert np.mean(apart) > 0.95
    got = {r.doc_id: r for r in language_id(spark, awkward).collect()}
    for i, t in enumerate(awkward_texts()):
        assert (got[i].lang_pred == UNKNOWN) == (not any(c.isalpha() for c in t or ""))
    assert language_id(spark, empty).count() == 0
    none = language_id(spark, frame(spark, ["abc", None], langs=[None, None])).collect()
    assert [(r.lang_pred, r.score) for r in none] == [(UNKNOWN, 0.0)] * 2


def test_language_learns_from_no_held_out_row(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    from pyspark.sql import functions as F
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "zz").otherwise(F.col("lang")))
    one, two = ({r.doc_id: (r.lang_pred, r.score) for r in language_id(spark, d).collect()} for d in (docs, other))
    assert one == two


def test_quality(spark, awkward, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality_scores(spark, docs, labels).collect()
    assert len(rows) == docs.count() and all(r.predicted == int(r.score >= 0.3) for r in rows)
    apart = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in apart]) > 0.93 and np.mean([p for p, t in apart if t]) > 0.97
    marks = "doc_id long, quality int"
    for some, low, high in (([], 0.5, 0.5), ([(i, 1) for i in range(30)], 0.99, 1), ([(i, 0) for i in range(30)], 0, 0.01),
                            ([(i, i % 2) for i in range(30)] + [(1, 5), (None, 1), (2, None), (999, 0)], 0, 1)):
        got = quality_scores(spark, awkward, spark.createDataFrame(some, marks)).collect()
        assert len(got) == len(awkward_texts()) and all(low <= r.score <= high for r in got)
    assert quality_scores(spark, empty, labels).count() == 0


@pytest.mark.parametrize("hot", [1 << 18, 5])
def test_lm_counts(spark, awkward, hot):
    texts = awkward_texts()
    tokens = [[w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(_LOWER)) if w] + [None] for t in texts]
    known = Counter(w for i, t in enumerate(tokens) if not held(i, 7, 2) for w in t)
    total = sum(known.values())
    got = {r.doc_id: r for r in lm_scores(spark, awkward, most_hot=hot).collect()}
    for i, t in enumerate(tokens):
        r = got[i]
        base = sum(np.log10((known[w] + 1) / (total + len(known) + 1)) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i, 7, 2), len(t), sum(known[w] > 0 for w in t), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and np.isfinite(r.score) and r.score < 0


def test_lm_scores_do_not_depend_on_hot_words(spark, awkward):
    """Every word's corpus frequency is mixed in, whether it is looked up or joined."""
    all_hot, few = ({r.doc_id: r.score for r in lm_scores(spark, awkward, most_hot=m).collect()} for m in (1 << 18, 5))
    assert few == pytest.approx(all_hot, rel=1e-5)


def test_lm_subword_counts(spark, awkward):
    """Subword frequencies are those of all texts."""
    from seismerge.llm import lm_score as L
    counts = (awkward.select("text").mapInArrow(L.counter, "word long, text binary, n long")
              .groupBy("word", "text").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n"))
    ids, n = L.subword_counts(counts, L.TOKENIZER)
    every = WordEncoder()
    raw = [(t or "").translate(_LOWER).encode() for t in awkward_texts()]
    want, _ = every.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw]))
    assert dict(zip(ids.tolist(), n.tolist())) == dict(zip(*(x.tolist() for x in np.unique(want, return_counts=True))))


def test_lm_without_training(spark, empty):
    assert lm_scores(spark, empty).count() == 0
    (r,) = lm_scores(spark, frame(spark, ["a b"], [None])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and r.score < 0


def test_attention_is_a_causal_distribution():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, 300)
    model = Attention(counts, rng.integers(0, 4, 300))
    ids = rng.integers(0, 20, 900) * 7
    before = model.log_probabilities(ids, np.array([0, 400, 400, 900])).mean()
    model.train(ids, np.array([0, 400, 400, 900]))
    bounds = np.array([0, 37])
    p = model.log_probabilities(ids[:37], bounds)
    assert model.log_probabilities(ids, np.array([0, 400, 400, 900])).mean() > before
    changed = ids[:37].copy()
    changed[20:] = 3
    assert np.allclose(p[:20], model.log_probabilities(changed, bounds)[:20], atol=1e-5)
    every = np.concatenate([np.append(ids[:25], i) for i in range(300)])
    last = model.log_probabilities(every, np.arange(301) * 26, at_once=7)[25::26]
    assert np.exp(last.astype(float)).sum() == pytest.approx(1, abs=1e-4)


def test_attention_gradient():
    """A training step goes down the loss that finite differences see."""
    rng = np.random.default_rng(1)
    ids, bounds = rng.integers(0, 60, 300), np.array([0, 300])
    model = Attention(np.bincount(ids, minlength=100), np.zeros(100, np.int64))
    losses = []
    for _ in range(2):
        losses.append(-model.log_probabilities(ids, bounds).mean())
        model.train(ids, bounds)
    assert losses[1] < losses[0]


def test_attention_gradient_by_differences():
    """The gradient is that of the mean loss, weight by weight."""
    from seismerge.llm.attention import TRAINED
    rng = np.random.default_rng(2)
    ids, bounds = rng.integers(0, 40, 90), np.array([0, 50, 51, 90])
    model = Attention(np.bincount(ids, minlength=60), rng.integers(0, 4, 60))
    model.out += rng.normal(0, 0.5, model.out.shape).astype(np.float32)
    model.bias += rng.normal(0, 0.5, model.bias.shape).astype(np.float32)

    def loss() -> float:
        return float(-(model.log_probabilities(ids, bounds) - model.inside[ids]).astype(float).mean())
    grad = model.gradient(*model.blocks(ids, bounds))
    for name in TRAINED:
        weights, want = getattr(model, name), grad[name]
        for at in np.argsort(-np.abs(want), axis=None)[[0, 3, 9]]:
            place, step = np.unravel_index(at, want.shape), np.float32(0.02)
            old = weights[place]
            sides = []
            for sign in (1, -1):
                weights[place] = old + sign * step
                sides.append(loss())
            weights[place] = old
            assert (sides[0] - sides[1]) / (2 * step) == pytest.approx(want[place], rel=0.05, abs=2e-4)


def test_lm_weights_learn_from_every_training_document(spark, monkeypatch):
    """Only held-out documents are kept from the pass over all partitions."""
    from seismerge.llm import lm_score as L
    passed = []
    monkeypatch.setattr(L, "averaged", lambda texts, tokenizer, saved: passed.extend(r.text for r in texts.collect()) or saved)
    texts = [f"{w} fish swims" for w in "one two red blue old new sad glad bad thin fat fast slow high low".split()] + [None]
    rows = lm_scores(spark, frame(spark, texts)).collect()
    assert sorted(passed) == sorted(texts[r.doc_id] or "" for r in rows if not r.held_out)


def test_lm_weights_are_averaged_by_blocks(spark):
    """Every partition goes on from the same weights; the mean counts each by
    its blocks, partitions without text not at all; without any, nothing changes."""
    from seismerge.llm import lm_score as L
    from seismerge.llm.attention import Adam
    split = L.Subwords(L.TOKENIZER)
    start = Attention(np.ones(split.end + 1), split.traits())
    parts = [["one fish two fish " * 30], ["red fish blue fish " * 9, "", "old fish"], []]
    texts = spark.createDataFrame(spark.sparkContext.parallelize(parts, 3).flatMap(lambda p: [(t,) for t in p]), "text string")
    total, blocks = 0, 0
    for part in parts[:2]:
        model = Attention.load(start.save())
        raw = [t.encode() for t in part]
        data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw])
        _, first_word, first = L.words_of(data, off)
        ids, bounds, _ = split(data, off, first_word, first)
        n = Adam(model).sweep(ids, bounds, L.SWEEP, L.SWEEP_RATE)
        total, blocks = total + n * model.weights().astype(float), blocks + n
    got = Attention.load(L.averaged(texts, L.TOKENIZER, start.save()))
    assert np.allclose(got.weights(), total / blocks, atol=1e-5)
    assert not np.allclose(got.weights(), start.weights(), atol=1e-5)
    same = Attention.load(L.averaged(texts.where("false"), L.TOKENIZER, start.save()))
    assert np.array_equal(same.weights(), start.weights())


def test_links_resolve_like_the_standard_says(spark):
    """Against the standard library, and the SQL against both."""
    import duckdb
    from urllib.parse import urljoin

    from seismerge.llm.oracle import OWN_PATH, RESOLVED
    from seismerge.llm.url_filter import resolved
    bases = ["http://h.com", "http://h.com/", "https://H.com/a/b/c.html?q=1/2#f", "http://h.com/a/", "http://h.com/a?x=/y/"]
    links = ["page.html", "./page", "../x", "../../../x/y", "?id=2", "#top", "/r/../s", "/r/./s/.", "x/..", "..", ".", "a/./b/../c?u=../v#..",
             "//other.net/p", "ftp://z.net/../q", "x" * 5000 + "/../y", "/", "a//b", "sp%20ace"]
    rows = [(u, k) for u in bases for k in links]
    got = {(r.url, r.link): r.to for r in spark.createDataFrame(rows, "url string, link string")
           .select("url", "link", resolved(F.col("url"), F.col("link")).alias("to")).collect()}
    for u, k in rows:
        if "//" not in k:
            assert got[u, k] == urljoin(u, k), (u, k)
    # Urls as they are; an empty step is kept (RFC 3986, 5.2.4), which urljoin does not do.
    assert {got[u, "ftp://z.net/../q"] for u in bases} == {"ftp://z.net/../q"}
    assert got[bases[1], "a//b"] == "http://h.com/a//b" and got[bases[2], "//other.net/p"] == "https://other.net/p"
    con = duckdb.connect()
    con.execute("CREATE TABLE t (url VARCHAR, link VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows + [(bases[2], "mailto:me@h.com")])
    sql = {(u, k): to for u, k, to in con.sql(f"SELECT url, link, {RESOLVED} FROM (SELECT *, {OWN_PATH} AS own FROM t)").fetchall()}
    assert sql.pop((bases[2], "mailto:me@h.com")) is None and sql == got
    other = spark.createDataFrame([(bases[2], "mailto:me@h.com"), (bases[2], None)], "url string, link string")
    assert [r[0] for r in other.select(resolved(F.col("url"), F.col("link"))).collect()][0] is None


def test_relative_canonical_carries_a_block(spark):
    pages = spark.createDataFrame([(1, "http://b.com/en/old.html", canonical("../de/new.html")), (2, "http://b.com/en/free.html", canonical("free.html")),
                                   (3, "http://b.com/de/new.html", None)], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter(spark, pages).collect()}
    assert got == {1: "block", 2: "allow", 3: "block"}


def test_training_steps_in_place():
    """The same weights, to the bit, as whole arrays give."""
    rng = np.random.default_rng(3)
    model = Attention(rng.integers(1, 500, 20000), rng.integers(0, 4, 20000))
    steps, m, v = Adam(model), {}, {}
    want = {n: getattr(model, n).copy() for n in TRAINED}
    for step in range(1, 4):
        grad = {n: rng.normal(size=want[n].shape).astype(np.float32) for n in TRAINED}
        model.gradient = lambda *blocks, grad=grad: grad
        steps.take(None, None, None, None, 0.01)
        for n in TRAINED:
            m[n] = m.get(n, np.zeros_like(want[n]))
            v[n] = v.get(n, np.zeros_like(want[n]))
            m[n] += 0.1 * (grad[n] - m[n])
            v[n] += 0.01 * (grad[n] ** 2 - v[n])
            want[n] -= (0.01 * (m[n] / (1 - 0.9 ** step)) / (np.sqrt(v[n] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    assert len(steps.spare[0]) < want["qkv"].size and all((getattr(model, n) == want[n]).all() for n in TRAINED)
