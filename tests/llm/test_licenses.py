"""The license scan against every rule run on every text, with plain suppression."""

import random
import re
import re._constants as C
import re._parser as P

import pytest
from texts import awkward_texts, frame, prose

from seismerge.llm import license_scan as L
from seismerge.llm.license_rules import RULES
from seismerge.llm.queries import op11

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCANNER = L.Scanner(RULES)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def naive(text):
    """All rules on the text, then suppression pair by pair."""
    words = words_of(text)
    line = (" " + " ".join(words) + " ").encode()
    found = [L.Detection(r.priority, line[:m.start()].count(b" ") - 1, line[:m.end()].count(b" ") - 1, r.order, L.label_of(r, m))
             for r in SCANNER.rules for m in r.pattern.finditer(line)]
    kept = []
    for d in sorted(found, key=lambda d: (-d.priority, -(d.last - d.first), d.order, d.first)):
        over = [k for k in kept if k.first <= d.last and d.first <= k.last]
        if any(k.priority > d.priority or (k.first <= d.first and d.last <= k.last) for k in over):
            continue
        kept.append(d)
    base = {}
    for phrase, label in L.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        if at:
            base[label] = at
    return len(words), base, sorted(kept, key=lambda d: (d.first, d.last, d.order))


def expected(text):
    n, base, kept = naive(text)
    starts = [s for v in base.values() for s in v]
    return (n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(set(base) | {d.label for d in kept})))


def result(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels


def sample(tokens, rng):
    """A text that an expression matches, but for its look-aheads."""
    out = b""
    for op, arg in tokens:
        if op is C.LITERAL:
            out += bytes([arg])
        elif op is C.IN:
            out += b"z" if arg[0][0] in (C.NEGATE, C.CATEGORY) else bytes([rng.choice([v for o, v in arg if o is C.LITERAL])])
        elif op is C.MAX_REPEAT:
            low, high, body = arg
            out += b"".join(sample(body, rng) for _ in range(rng.randint(low, min(high, low + 2))))
        elif op is C.SUBPATTERN:
            out += sample(arg[3], rng)
        elif op is C.BRANCH:
            out += sample(rng.choice(arg[1]), rng)
        elif op not in (C.ASSERT, C.ASSERT_NOT):
            raise AssertionError(op)
    return out


def samples(rule, n, seed=0):
    rng = random.Random(seed)
    return [sample(P.parse(rule.pattern.pattern), rng).decode() for _ in range(n)]


def test_hundreds_of_rules_each_reachable():
    assert len(SCANNER.rules) > 250
    for rule in SCANNER.rules:
        for text in samples(rule, 25):
            assert rule.pattern.search(f" {text} ".encode()), (rule, text)
            assert rule in SCANNER.called(set(text.encode().split())), (rule, text)


def test_prefilter_and_suppression_equal_the_plain_scan():
    rng = random.Random(5)
    pool = [t for r in SCANNER.rules for t in samples(r, 2, 1)]
    for k in range(400):
        parts = rng.sample(pool, rng.randrange(1, 9))
        parts = [" ".join(p.split()[rng.randrange(3):]) if rng.random() < 0.3 else p for p in parts]
        text = " ".join(w for p in parts for w in ([p, prose(k, rng.randrange(3))] if rng.random() < 0.5 else [p]))
        assert SCANNER.scan(text.encode()) == naive(text), text


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("Released under the MIT License.", "mit"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0-or-later"),
    ("# SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("see https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa-4.0"),
    ("GNU Lesser General Public License v2.1", "lgpl-2.1"),
    ("Mozilla Public License 2.0 and the Apache License", "apache,mpl-2.0"),
    ("the gnu general public licensed", ""), ("cc bye", ""), ("mit lizenz, mit license-free", "mit")])
def test_labels(text, labels):
    _, base, found = SCANNER.scan(text.encode())
    assert ",".join(sorted(set(base) | {d.label for d in found})) == labels


def test_awkward_texts(spark):
    texts = [*awkward_texts(), "MIT\x00License", "cc by cc by", "gnu general public license " * 3000, "mit  LICENSE.\n\nÉ apache license",
             "apache licenseé", "ſ cc BY", prose(9, 30000) + " Apache License, Version 2.0"]
    got = {r.doc_id: r for r in L.license_scan(spark, frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert result(got[i]) == expected(t), t
        assert 0 <= got[i].score <= 1 and (got[i].score > 0) == bool(got[i].labels)


def test_repeated_and_null_ids_and_empty(spark, empty):
    rows = L.license_scan(spark, frame(spark, ["mit license"] * 4, [1, 1, None, None])).collect()
    assert sorted((r.doc_id or 0, r.labels) for r in rows) == [(0, "mit")] * 2 + [(1, "mit")] * 2
    assert L.license_scan(spark, empty).count() == 0


def test_detections_have_places(spark):
    (r,) = L.license_scan(spark, frame(spark, ["We use it under the Apache License, Version 2.0; all rights reserved."])).collect()
    assert [(d.label, d.first_word, d.last_word) for d in r.detections] == [("apache-2.0", 3, 9), ("all-rights-reserved", 10, 12)]
    assert r.score == 0.95 and r.n_base == 1 and r.first_word == r.last_word == 5


def test_query_equals_plain_scan(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: result(r) for r in op11(spark, sf_dir).collect()}
    assert got == {i: expected(t) for i, t in texts.items()}
