"""License scan with ordered signature rules.

A text is taken as its words, lower-cased and joined by single blanks, and a
few hundred expressions (``license_rules.RULES``) look for passages, notices,
names and hints in it. The words of a text say which rules can match at all:
each rule names keywords that its every match holds, so that most texts run no
expression. Overlapping detections are resolved by priority (a detection that
overlaps one of higher priority goes) and, within a priority, by containment
(an interval inside another one goes; of equal ones the earlier rule's stays).

Beside the rules, base phrases are counted at all places; their labels stay
whatever the rules say. One pass over the table, nothing is shuffled; a task
holds one slice of texts.

Defined results: a null text counts as empty; without words all counts are 0,
labels empty and positions null; equal rows and repeated or null ids give one
row each; extra columns are ignored; texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.llm.common import numbered, slices
from seismerge.llm.license_rules import RULES
from seismerge.llm.ordering import batched

#: Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: How sure a kept detection of each priority is.
CONFIDENCE = {5: 1.0, 4: 0.95, 3: 0.85, 2: 0.7, 1: 0.4}

#: Bytes to word bytes or blanks: A-Z lower-cased, separators blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Rule(NamedTuple):
    order: int
    priority: int
    label: str
    keywords: tuple[frozenset[bytes], ...]
    pattern: re.Pattern


class Detection(NamedTuple):
    priority: int
    first: int
    last: int
    order: int
    label: str


def rules_of(text: str) -> list[Rule]:
    rules = []
    for line in text.splitlines():
        if not line.strip() or line.startswith("#"):
            continue
        head, keywords, expression = line.split(" : ", 2)
        priority, label = head.split()
        rules.append(Rule(len(rules), int(priority), label,
                          tuple(frozenset(w.encode() for w in k.split("/")) for k in keywords.split()),
                          re.compile(rb"(?<= )(?:" + expression.strip().encode() + rb")(?= )")))
    return rules


class Scanner:
    """Rules by the keywords that can call them."""

    def __init__(self, text: str) -> None:
        self.rules = rules_of(text)
        self.calls: dict[bytes, list[Rule]] = {}
        for rule in self.rules:
            for word in rule.keywords[0]:
                self.calls.setdefault(word, []).append(rule)
        self.first_words = frozenset(self.calls)
        self.base = [(phrase.encode().split(), re.compile(rb"(?<= )(?=" + phrase.encode() + rb" )"), label) for phrase, label in BASE.items()]

    def called(self, words: set[bytes]) -> list[Rule]:
        """The rules whose keywords are all among ``words``, in order."""
        out = {rule.order: rule for w in self.first_words & words for rule in self.calls[w]
               if all(not k.isdisjoint(words) for k in rule.keywords)}
        return [out[o] for o in sorted(out)]

    def scan(self, text: bytes) -> tuple[int, dict[str, list[int]], list[Detection]]:
        """Number of words, places of each base label, detections that stay."""
        words = text.translate(TABLE).split()
        known = set(words)
        rules = self.called(known)
        base = [(pattern, label) for phrase, pattern, label in self.base if known.issuperset(phrase)]
        if not rules and not base:
            return len(words), {}, []
        line = b" " + b" ".join(words) + b" "
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)

        def word(at: int) -> int:
            return int(np.searchsorted(blanks, at)) - 1
        places: dict[str, list[int]] = {}
        for pattern, label in base:
            found = [word(m.start()) for m in pattern.finditer(line)]
            if found:
                places[label] = found
        detections = [Detection(rule.priority, word(m.start()), word(m.end()), rule.order, label_of(rule, m))
                      for rule in rules for m in rule.pattern.finditer(line)]
        return len(words), places, resolved(detections)


def label_of(rule: Rule, match: re.Match) -> str:
    return rule.label.replace("{1}", (match[1] or b"").decode().replace(" ", ".")) if "{1}" in rule.label else rule.label


def resolved(detections: list[Detection]) -> list[Detection]:
    """Detections that stay, by place. ``last`` is a detection's last word."""
    kept: list[Detection] = []
    covered: list[tuple[int, int]] = []  # disjoint intervals of all higher priorities
    for priority in sorted({d.priority for d in detections}, reverse=True):
        starts, latest, here = [s for s, _ in covered], -1, []
        for d in sorted((d for d in detections if d.priority == priority), key=lambda d: (d.first, -d.last, d.order)):
            if d.last <= latest:
                continue  # inside one that starts no later
            k = bisect_right(starts, d.last) - 1
            if k >= 0 and covered[k][1] >= d.first:
                continue
            here.append(d)
            latest = d.last
        kept += here
        covered = joined(covered + [(d.first, d.last) for d in here])
    return sorted(kept, key=lambda d: (d.first, d.last, d.order))


def joined(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


@lru_cache(maxsize=4)
def scanner(text: str) -> Scanner:
    return Scanner(text)


_FOUND = pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int32()), ("rule", pa.int32()), ("first_word", pa.int64()),
                             ("last_word", pa.int64())]))
RESULT = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                    ("detections", _FOUND)])
RESULT_DDL = ("row long, doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
              "score double, detections array<struct<label: string, priority: int, rule: int, first_word: long, last_word: long>>")


def scan_batches(batches: Iterator[pa.RecordBatch], rules: str) -> Iterator[pa.RecordBatch]:
    scan = scanner(rules).scan

    def rows() -> Iterator[tuple]:
        for batch, data, off in slices(batches):
            raw = data.tobytes()
            for row, doc, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), off[:-1].tolist(), off[1:].tolist()):
                n, places, found = scan(raw[a:b])
                starts = [s for v in places.values() for s in v]
                yield (row, doc, n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(places)),
                       ",".join(sorted(set(places) | {d.label for d in found})),
                       max((CONFIDENCE[d.priority] for d in found), default=CONFIDENCE[2] if places else 0.0),
                       [{"label": d.label, "priority": d.priority, "rule": d.order, "first_word": d.first, "last_word": d.last} for d in found])
    yield from batched(rows(), RESULT)


def license_scan(spark: SparkSession, docs: DataFrame, rules: str = RULES) -> DataFrame:
    """One row per document: row, doc_id, n_words, n_base (places of base
    phrases), first_word and last_word (their first and last start),
    base_labels, labels (with those of the rules), score (of the surest
    detection), detections (those that stay, by place)."""
    return docs.select(numbered(spark).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        partial(scan_batches, rules=rules), RESULT_DDL)
