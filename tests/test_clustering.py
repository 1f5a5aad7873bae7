"""Clustering, written from the rule: a report joins a cluster whose newest
member is at most 90 s older, whose centroid is at most 50 km away and whose
mean magnitude differs by at most 1.0 (if both are known)."""

import itertools
import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from seismerge.operators import cluster as C
from seismerge.operators.space_time import space_time_blocks
from tests.conftest import T0, ev, reports_df, secs

KM = math.pi * 6371.0088 / 180  # along a meridian, per degree
AGENCIES = ["AFAD", "KOERI", "EMSC", "USGS"]


def facts(spark, rows, scan="creation_break", **limits):
    return [r.asDict(recursive=True) for r in C.dedupe(reports_df(spark, rows), as_of="2026-02-02", scan=scan, **limits).collect()]


def pairs(spark, cases):
    """For many two-report cases at once, a day apart: does the pair merge?
    A case is (seconds, km, first magnitude, second magnitude)."""
    rows = []
    for k, (s, km, m1, m2) in enumerate(cases):
        t = T0 + timedelta(days=k)
        rows += [ev("AFAD", t, -12.5, 44.0, m1, event_id=f"a{k}"), ev("EMSC", t + timedelta(seconds=s), -12.5 + km / KM, 44.0, m2, event_id=f"b{k}")]
    heads = {r.event_id: r.cluster_head for r in C.cluster_members(C.assign_clusters(C.time_sessions(reports_df(spark, rows)))).collect()}
    return [heads[f"a{k}"] == heads[f"b{k}"] for k in range(len(cases))]


def test_limits_from_both_sides(spark):
    cases = {(89.999999, 0, 2, 2): True, (90, 0, 2, 2): True, (90.000001, 0, 2, 2): False,
             (0, 49.999, 2, 2): True, (0, 50.001, 2, 2): False,
             (0, 0, 2.0, 3.0): True, (0, 0, 3.0, 2.0): True, (0, 0, 2.0, 3.0000001): False,
             (0, 0, None, 9): True, (0, 0, 9, None): True, (0, 0, None, None): True,
             (90, 49.9, 4.5, 5.5): True, (90, 50.1, 4.5, 4.5): False}
    assert pairs(spark, list(cases)) == list(cases.values())


def test_limits_are_arguments(spark):
    rows = [ev("AFAD", T0, 1.0, 2.0, 3.0, event_id="x"), ev("EMSC", T0 + secs(60), 1.0, 2.0 + 80 / KM, 3.8, event_id="y")]
    assert [len(facts(spark, rows, **k)) for k in ({}, {"dist_km": 81.0}, {"dist_km": 81.0, "dt_window_s": 59.0}, {"dist_km": 81.0, "dm": 0.7})] == [2, 1, 2, 2]


def generated(seed, events=25):
    """Events hours apart, each reported by some agencies within the limits."""
    rng, rows, want = random.Random(seed), [], {}
    for e in range(events):
        t, lat, lon = T0 + timedelta(hours=2 * e), rng.uniform(-60, 60), rng.uniform(-170, 170)
        who = rng.sample(AGENCIES, rng.randint(1, 4))
        members = []
        for a in who:
            members.append(ev(a, t + timedelta(microseconds=rng.randrange(40_000_000)), lat + rng.uniform(-.1, .1), lon + rng.uniform(-.1, .1),
                              rng.choice([None, 3.1, 3.4]), place=f"{a} {e}", event_id=f"{a}-{e}"))
        rows += members
        want[e] = members
    rng.shuffle(rows)
    return rows, want


def test_fact_fields_of_generated_events(spark):
    """Agreement, sources, preferred report and first time of every event."""
    rows, want = generated(4)
    got = {int(f["source_values"][f["preferred_source"]]["event_id"].split("-")[1]): f for f in facts(spark, rows)}
    assert sorted(got) == sorted(want)
    for e, members in want.items():
        f, best = got[e], min(members, key=lambda m: AGENCIES.index(m[0]))
        assert f["sources"] == sorted(m[0] for m in members) and f["agreement_level"] == len(members)
        assert (f["preferred_source"], f["latitude"], f["longitude"], f["magnitude"], f["place"]) == (best[0], best[3], best[4], best[6], best[8])
        assert f["event_time"] == f["first_seen_at"] == min(m[2] for m in members).replace(tzinfo=None)
        assert {a: v["event_id"] for a, v in f["source_values"].items()} == {m[0]: m[1] for m in members}


def test_priority_in_any_order_of_arrival(spark):
    """The preferred agency does not depend on who reports first."""
    rows, want = [], {}
    for k, order in enumerate(o for n in range(1, 5) for o in itertools.permutations(range(4), n)):
        t = T0 + timedelta(hours=k)
        rows += [ev(AGENCIES[a], t + secs(5 * i), 20.0, 30.0, 2.0 + a / 10, event_id=f"{a}-{k}") for i, a in enumerate(order)]
        want[t.replace(tzinfo=None)] = (AGENCIES[min(order)], 2.0 + min(order) / 10, len(order))
    assert {f["event_time"]: (f["preferred_source"], f["magnitude"], f["agreement_level"]) for f in facts(spark, rows)} == want


def test_order_of_input_rows_does_not_matter(spark):
    rows, _ = generated(9, 12)
    again = random.Random(1).sample(rows, len(rows))
    assert sorted(map(repr, facts(spark, rows))) == sorted(map(repr, facts(spark, again)))


def test_repeated_agency_last_value_counts_once(spark):
    rows = [ev("KOERI", T0 + secs(7 * k), 5.0, 6.0, 2.0 + k / 10, event_id=f"k{k}") for k in range(5)]
    (f,) = facts(spark, rows)
    assert f["agreement_level"] == 1 and f["source_values"]["KOERI"]["event_id"] == "k4" and f["magnitude"] == 2.0


def test_two_clusters_with_one_uid_the_later_wins(spark):
    """Same bucket and rounded place, kept apart by magnitude only."""
    start = T0.replace(hour=0, minute=0, second=0)  # midnight is a bucket border
    rows = [ev("AFAD", start + secs(1), 10.0, 20.0, 2.0, event_id="low"), ev("AFAD", start + secs(2), 10.0, 20.0, 6.0, event_id="high")]
    (f,) = facts(spark, rows)
    assert f["magnitude"] == 6.0


def test_scan_modes_differ_as_documented(spark):
    # A0(0 s), far B(1 s), A1(80 s), A2(120 s): the creation-order break
    # misses A0's cluster for A2; the window rule does not.
    rows = [ev("AFAD", T0, 38.5, 31.25, 3.0, event_id="A0"), ev("AFAD", T0 + secs(1), 28.0, 19.0, 3.0, event_id="B"),
            ev("AFAD", T0 + secs(80), 38.5, 31.25, 3.0, event_id="A1"),
            ev("AFAD", T0 + secs(120), 38.5, 31.25, 3.0, event_id="A2")]
    assert len(facts(spark, rows, "creation_break")) == 3
    assert len(facts(spark, rows, "window")) == 2


def test_empty_input(spark):
    assert facts(spark, []) == [] == facts(spark, [], "window")


def test_sessions_split_only_on_gaps_over_window(spark):
    rows = [ev("AFAD", T0 + secs(s), 38.5, 31.25, 3.0, event_id=str(s)) for s in (0, 90, 180, 271, 5000)]
    s = C.time_sessions(reports_df(spark, rows))
    got = {r.event_id: r.session for r in s.collect()}
    assert got["0"] == got["90"] == got["180"] and got["271"] != got["180"] and got["5000"] != got["271"]


def test_sessions_agree_with_session_window(spark):
    """Spark's own session_window (90 s gap) groups the fixture's reports into
    the same number of sessions."""
    from seismerge.sources.testdata import canonical_reports
    rep = canonical_reports(spark, "/root/testdata/sf0.001")
    ours = C.time_sessions(rep).select("session").distinct().count()
    # session_window closes a session when the next event starts after the
    # previous end (t + gap); a gap of exactly 90 s stays in one session.
    assert ours == rep.groupBy(F.session_window("event_time", "90 seconds")).count().count()


def blocks_of(spark, rows):
    s = C.time_sessions(reports_df(spark, rows))
    return {r.event_id: r.block for r in space_time_blocks(s, 90_000_000, 110.0).collect()}


def test_blocks_follow_time_and_space(spark):
    """A chain of near reports is one block across chunks of time; a gap in
    time or space ends it, within one session."""
    chain = [ev("AFAD", T0 + secs(80 * k), 38.5 + k * 0.002, 31.25, 3.0, event_id=f"c{k}") for k in range(200)]
    keep_awake = [ev("USGS", T0 + secs(60 * k), -30.0, -100.0 + 10 * (k % 3), 3.0, event_id=f"u{k}") for k in range(400)]
    late = [ev("AFAD", T0 + secs(80 * 200 + 300), 38.9, 31.25, 3.0, event_id="late")]
    got = blocks_of(spark, chain + keep_awake + late)
    assert len({got[f"c{k}"] for k in range(200)}) == 1 and got["late"] != got["c199"]
    assert len({got[f"u{k}"] for k in range(400)}) == 400
    assert not {got["c0"], got["late"]} & {got[f"u{k}"] for k in range(400)}


def test_reports_at_odd_places_unite_their_buckets(spark):
    rows = [ev("AFAD", T0 + secs(s), lat, lon, 3.0, event_id=n) for n, s, lat, lon in
            (("a", 0, 38.5, 31.2), ("b", 5, -10.0, 100.0), ("pole", 20, 86.0, 10.0), ("c", 5000, 38.5, 31.2), ("d", 5005, -10.0, 100.0),
             ("edge", 9000, 1.0, 179.9), ("e", 9050, 1.0, -179.9), ("f", 9060, 50.0, 5.0))]
    got = blocks_of(spark, rows)
    assert got["a"] == got["b"] == got["pole"] and got["edge"] == got["e"] == got["f"]
    assert len({got[n] for n in ("a", "c", "d", "edge")}) == 4


@pytest.mark.parametrize("centre", [(61.0, 179.7), (-84.0, 20.0)])
def test_blocks_do_not_change_the_walk(spark, centre):
    """Random swarms near the antimeridian and near a pole."""
    rng = random.Random(str(centre))
    rows = []
    for k in range(250):
        lon = (centre[1] + rng.uniform(-6, 6) + 180) % 360 - 180
        rows.append(ev(rng.choice(AGENCIES), T0 + timedelta(milliseconds=rng.randrange(4_000_000)), max(-89.9, min(89.9, centre[0] + rng.uniform(-5, 5))),
                       lon, rng.choice([None, 2.0, 2.6, 3.5]), event_id=f"r{k}"))
    s = C.time_sessions(reports_df(spark, rows))
    heads = [sorted((r.event_id, r.cluster_head, r.cluster_size) for r in C.cluster_members(C.assign_clusters(
        s, scan="window", spatial_split=split, piece_reports=n)).collect()) for split, n in ((False, None), (True, 40))]
    assert heads[0] == heads[1]
