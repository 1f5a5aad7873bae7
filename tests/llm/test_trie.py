"""The conversation trie against a plain statement of it."""

import hashlib
import random
import re
import zlib

import pytest

from seismerge.llm import conversation_trie as T
from seismerge.llm.queries import op13

#: Columns beyond those of conversations, named like what the operator uses inside.
SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth string, seq string, n string, row string, k string, size string"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", sha(f"{len((role or '').encode())}:{role or ''}{text or ''}"), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    nodes, ends = {}, {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - c % 20, [])[:h] + mine[h:])
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    kids, leaves, saved = {}, dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for s in nodes:
        if s:
            kids[s[:-1]] = kids.get(s[:-1], 0) + 1
    for s, members in nodes.items():
        words = len(re.findall(T.WORD, s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += (len(members) - 1) * words
    return sorted((min(m), len(s), min(nodes[s[:-1]]) if s else -1, len(m), kids.get(s, 0), leaves[s], saved[s],
                   sha(",".join(map(str, sorted(ends.get(s, [])))))) for s, m in nodes.items())


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "c", "d", "s", "n", "r", "k", "z") for r in rows], SCHEMA)
    got = sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                  r.saved_tokens, r.ends_sha256) for r in T.conversation_trie(spark, df, **options).collect())
    want = brute(rows)
    assert len(got) == len(want)
    assert got == want


def conversations(seed, n, longest, alphabet, ids):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(ids), n):
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(alphabet)) for t in range(rng.randrange(1, longest + 1))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment, block", [(64, 4096), (3, 5), (5, 1)])
def test_random(spark, segment, block):
    """Segments and blocks of any size give the same trie."""
    check(spark, conversations(segment, 150, 9, ["a b", "c"], 400), segment=segment, block=block)


def test_long_shared_beginnings(spark):
    """Copies of long conversations, which part late or end early."""
    rng = random.Random(3)
    long = [("user", f"turn {k} x") for k in range(200)]
    rows = []
    for c in range(0, 60):
        seq = long[:rng.choice([200, 64, 128, 129, 130, 190])] + ([("user", f"own {c % 5}")] * rng.randrange(3) if c % 2 else [])
        rows += [(c, t, *x) for t, x in enumerate(seq)]
    check(spark, rows)
    check(spark, rows, segment=50, block=3)


def test_nulls_ties_and_turnless(spark):
    rows = [(1, None, None, None), (1, None, "user", "x"), (1, 0, "user", None), (1, 0, "user", ""), (2, 5, "user", "x y"), (2, 5, "user", "x y"),
            (None, 0, "user", "lost"), (3, 0, "a", "b" * 70000), (-7, 1, "user", "n"), (-7, 0, "system", " \t "), (-40, 0, "s", "t"), (47, 0, "u", "é w\x00z")]
    rows += [(c, 0, "user", "only") for c in range(400, 440)] + [(c, 0, "user", "one") for c in range(801, 820)]
    check(spark, rows)
    check(spark, rows, segment=2, block=2)


def test_one_conversation_and_none(spark):
    check(spark, [(0, 0, "user", "a b c")])
    empty = spark.createDataFrame([], SCHEMA)
    assert T.conversation_trie(spark, empty).count() == 0


def test_large_groups_of_copies(spark):
    """Digests of members over many pieces, whatever partition they are in."""
    rows = [(c, t, "user", f"t{t}") for c in range(9000) for t in range(2)]
    check(spark, rows)


def test_identities_over_chains_of_segments(spark):
    """A window adds up a chain of segments, chains are added up in turn."""
    rows = [(c, d, d * 2, f"{d % 3:032d}", 1) for c, n in ((1, 23), (2, 23), (3, 20), (4, 1)) for d in range(n + 1)]
    rows = [(c, {1: 23, 2: 23, 3: 20, 4: 1}[c], d, "" if d == 0 else t, w) for c, d, _, t, w in rows]
    turns = spark.createDataFrame(rows, "conv long, total long, depth long, tid string, words int")
    one, two = ({(r.conv, r.k): (r.p1, r.p2, r.f1, r.f2, r.ends) for r in T.segments(spark, turns, 2, chain).collect()} for chain in (3, 1000))
    assert one == two
    assert all(one[c, k][:2] == one[c, k - 1][2:4] for c, k in one if k) and one[1, 0][:2] == (0, 0)
    assert one[1, 11] == one[2, 11] and one[1, 8] == one[2, 8] and one[1, 11][4] and not one[1, 9][4] and one[3, 9][4]


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    got = sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                  r.saved_tokens, r.ends_sha256) for r in op13(spark, sf_dir).collect())
    assert got == brute(rows)
