"""Randomised check of the distributed walk against a plain statement of
the rule (sorted reports, one pass, clusters as member lists)."""

import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from seismerge.operators import cluster as C
from tests.conftest import T0, reports_df

PRIO = {"AFAD": 0, "KOERI": 1, "EMSC": 2, "USGS": 3}


def hav(a, b, c, d):
    r1, r2 = math.radians(a), math.radians(c)
    x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(r1) * math.cos(r2) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(x)))


def mean(values):
    total = 0.0
    for v in values:
        total += v
    return total / len(values)


def reachable(clusters, when, scan):
    """Clusters, newest first, that a report at ``when`` may look at, with their gap."""
    gaps = [(c, (when - max(m[2] for m in c)).total_seconds()) for c in reversed(clusters)]
    if scan == "creation_break":
        stale = next((k for k, (_, gap) in enumerate(gaps) if gap > 90), len(gaps))
        return gaps[:stale]
    return [(c, gap) for c, gap in gaps if gap <= 90]


def fits(report, cluster):
    near = hav(report[3], report[4], mean([m[3] for m in cluster]), mean([m[4] for m in cluster])) <= 50
    known = [m[6] for m in cluster if m[6] is not None]
    return near and (report[6] is None or not known or abs(report[6] - mean(known)) <= 1.0)


def plain(rows, scan):
    """Of the clusters that fit, a report takes the one with the least gap, the
    newest of equals; without one it opens its own."""
    clusters = []
    for r in sorted(rows, key=lambda r: (r[2], PRIO[r[0]], r[0], r[1])):
        options = [(gap, age, c) for age, (c, gap) in enumerate(reachable(clusters, r[2], scan)) if fits(r, c)]
        if options:
            min(options, key=lambda o: o[:2])[2].append(r)
        else:
            clusters.append([r])
    return {m[1]: c[0][1] for c in clusters for m in c}


@pytest.mark.parametrize("scan", ["creation_break", "window"])
def test_walk_equals_plain_rule(spark, scan):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        src = rnd.choice(list(PRIO))
        t = T0 + timedelta(seconds=rnd.randint(0, 3000), microseconds=rnd.choice([0, 500000]))
        mag = None if rnd.random() < 0.1 else round(rnd.uniform(1, 5), 1)
        rows.append((src, f"r{i}", t, round(40 + rnd.uniform(-0.6, 0.6), 2),
                     round(29 + rnd.uniform(-0.6, 0.6), 2), 10.0, mag, "ML", None, None, None))
    expect = plain(rows, scan)
    a = C.cluster_members(C.assign_clusters(C.time_sessions(reports_df(spark, rows)), scan=scan))
    got = {r.event_id: r.cluster_head.split(":", 1)[1] for r in a.collect()}
    assert got == expect

@pytest.mark.parametrize("scan", ["creation_break", "window"])
@pytest.mark.parametrize("piece_reports,warm", [(40, 20), (25, 1), (7, 0)])
def test_pieces_equal_the_whole_walk(spark, scan, piece_reports, warm):
    """One dense session cut into pieces, with warm-ups that suffice and that do not."""
    rnd = random.Random(11)
    rows, t = [], T0
    for i in range(400):
        t += timedelta(seconds=rnd.choice([0, 3, 10, 40]))
        mag = None if rnd.random() < 0.1 else round(rnd.uniform(2, 4), 1)
        rows.append((rnd.choice(list(PRIO)), f"r{i}", t, round(40 + rnd.uniform(-0.5, 0.5), 2),
                     round(29 + rnd.uniform(-0.5, 0.5), 2), 10.0, mag, "ML", None, None, None))
    s = C.time_sessions(reports_df(spark, rows))
    heads = [sorted((r.event_id, r.cluster_head, r.cluster_size) for r in C.cluster_members(C.assign_clusters(
        s, scan=scan, piece_reports=n, warm_windows=warm)).collect()) for n in (None, piece_reports)]
    assert heads[0] == heads[1]
    assert {e: h.split(":")[1] for e, h, _ in heads[1]} == plain(rows, scan)
    facts = [C.build_facts(C.assign_clusters(s, scan=scan, piece_reports=n, warm_windows=warm), as_of="2025-02-01") for n in (None, piece_reports)]
    drop = ("cluster_key",)
    assert sorted(map(repr, facts[0].drop(*drop).collect())) == sorted(map(repr, facts[1].drop(*drop).collect()))


def test_a_report_looks_at_the_clusters_around_it(spark, monkeypatch):
    """A thousand clusters open at once, far apart: hardly any distance is taken."""
    taken = []
    whole = C._surface_km
    monkeypatch.setattr(C, "_surface_km", lambda *a: taken.append(a) or whole(*a))
    walk = C._Walk(90_000_000, 50.0, 1.0, True)
    at = [(lat, lon) for lat in range(-80, 81, 6) for lon in range(-180, 180, 10)]
    ids = [walk.place(k, *p, 3.0, k) for k, p in enumerate(at + at)]
    assert ids == 2 * list(range(len(at))) and len(walk.open) == len(at)
    assert len(taken) < 20 * len(at)


def endless(n, every=8):
    """Reports of places that never rest, so that no cluster closes, and rarer ones between."""
    rnd = random.Random(5)
    return [(rnd.choice(list(PRIO)), f"r{i}", T0 + timedelta(seconds=every * i), round(10 + 0.3 * (i % 7) + rnd.uniform(-0.2, 0.2), 3), 20.0, 10.0,
             round(rnd.uniform(2, 3.4), 1), "ML", None, None, None) for i in range(n)]


def test_rounds_grow_with_the_logarithm_of_the_pieces(spark, monkeypatch):
    rounds = []
    kept = C.written
    monkeypatch.setattr(C, "written", lambda spark, df, name: rounds.append(name) or kept(spark, df, name))
    rows = endless(600)
    s = C.time_sessions(reports_df(spark, rows))
    a = C.cluster_members(C.assign_clusters(s, scan="window", piece_reports=10, warm_windows=0))
    assert {r.event_id: r.cluster_head.split(":", 1)[1] for r in a.collect()} == plain(rows, "window")
    assert rounds.count("walked") <= 8


def test_pieces_last_longer_than_their_warm_up(spark):
    s = C.time_sessions(reports_df(spark, endless(400))).withColumn("block", F.col("session"))
    per = C.piece_table(s, 90_000_000, 5, 12).groupBy("piece").count().collect()
    assert len(per) == 3 and max(r["count"] for r in per) == 12


def test_a_long_chain_is_walked_once_with_its_reports(spark, monkeypatch):
    """Where no cluster ever closes, borders are found on packed numbers; the
    reports themselves are not walked again for each that was wrong."""
    names, kept = [], C.written
    monkeypatch.setattr(C, "written", lambda spark, df, name: names.append(name) or kept(spark, df, name))
    rows = endless(600)
    for scan in C.SCAN_MODES:
        names.clear()
        a = C.cluster_members(C.assign_clusters(C.time_sessions(reports_df(spark, rows)), scan=scan, piece_reports=10, warm_windows=0))
        assert {r.event_id: r.cluster_head.split(":", 1)[1] for r in a.collect()} == plain(rows, scan)
        assert names.count("walked") == 1 and names.count("mended") == 1


def test_borders_that_depend_on_one_piece_need_no_chain(spark, monkeypatch):
    names, kept = [], C.written
    monkeypatch.setattr(C, "written", lambda spark, df, name: names.append(name) or kept(spark, df, name))
    rows = [(s, f"{s}{i}", T0 + timedelta(seconds=80 * i), 40.0, 20.0 + 3 * (i % 5), 10.0, 3.0, "ML", None, None, None) for i in range(100) for s in PRIO]
    C.assign_clusters(C.time_sessions(reports_df(spark, rows)), piece_reports=40, warm_windows=1)
    assert names.count("borders") == 2 and "mended" not in names


@pytest.mark.parametrize("scan", ["creation_break", "window"])
def test_repeated_keys_in_pieces(spark, scan):
    """Reports with one key that open clusters of their own stay apart."""
    rows = [("AFAD", f"r{i % 3}", T0 + timedelta(seconds=60 * i), 10.0 + 2 * (i % 4), 20.0, 10.0, None if i % 5 == 0 else 3.0, "ML", None, None, None)
            for i in range(120)]
    s = C.time_sessions(reports_df(spark, rows))
    sizes = [sorted(C.assign_clusters(s, scan=scan, piece_reports=n, warm_windows=0).groupBy("block", "cluster_seq").agg(
        F.min("us"), F.max("us"), F.count("*"), F.min("latitude"), F.max("latitude")).drop("block", "cluster_seq").collect()) for n in (None, 10)]
    assert sizes[0] == sizes[1]


def test_the_packed_walk_gives_up_empty_cells(spark):
    """Limits so short that every report has a cell of its own; reports without a place too."""
    rnd = random.Random(3)
    rows = [("AFAD", f"r{i}", T0 + timedelta(milliseconds=i), math.nan if i % 97 == 0 else rnd.uniform(-89, 89), rnd.uniform(-180, 180), 10.0,
             None if i % 7 == 0 else rnd.uniform(1, 6), "ML", None, None, None) for i in range(70_000)]
    s = C.time_sessions(reports_df(spark, rows), 0.5)
    got = [sorted((r[0], r[1]) for r in C.assign_clusters(s, 0.5, 20.0, piece_reports=n).groupBy("block", "cluster_seq").agg(
        F.min("event_id"), F.count("*")).drop("block", "cluster_seq").collect()) for n in (None, 9_000)]
    assert got[0] == got[1]
