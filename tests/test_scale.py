"""Work done once: what a job reads, tokenises, shuffles or measures."""

import json
import tempfile
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F, types as T

from seismerge.operators import cluster as C
from seismerge.operators.canonical import harmonize
from seismerge.operators.quality import quarantine_harmonized
from seismerge.plans import store
from seismerge.sources.documents import to_documents
from seismerge.sources.parse import parse_json_responses, parse_koeri_responses
from seismerge.sources.testdata import fixture_responses
from seismerge.streaming import jobs as J
from seismerge.streaming.tables import BatchTable
from tests.conftest import ev, reports_df


def test_a_clear_distance_is_not_computed(monkeypatch):
    """The chord tells near from far; only at the limit the distance is taken."""
    taken, whole = [], C._surface_km
    monkeypatch.setattr(C, "_surface_km", lambda *a: taken.append(a) or whole(*a))
    walk = C._Walk(90_000_000, 50.0, 1.0, True)
    at = [(40.0, 29.0), (40.1, 29.0), (40.0, 29.9), (40.1, 29.8)]
    assert [walk.place(k, *p, 3.0, k) for k, p in enumerate(at)] == [0, 0, 2, 2] and not taken
    limit = whole((40.0, 29.0), (40.3, 29.2))
    for less in (0.0, 1e-12):
        walk = C._Walk(90_000_000, limit - less * limit, 1.0, True)
        assert [walk.place(0, 40.3, 29.2, 3.0, 0), walk.place(1, 40.0, 29.0, 3.0, 1)] == [0, int(less > 0)]
    assert len(taken) == 2


def test_days_that_silver_lacks_are_not_read(spark, monkeypatch):
    """Reports next to both ends of the only day there is: one look suffices."""
    looks, kept = [], J.written
    monkeypatch.setattr(J, "written", lambda s, df, name: looks.append(name) or kept(s, df, name))
    rows = [ev("AFAD", datetime(2025, 1, 10, *t, tzinfo=timezone.utc), 40, 29) for t in ((0, 0, 5), (23, 59, 55))]
    path = tempfile.mkdtemp() + "/silver"
    reports_df(spark, rows).withColumn("day", F.to_date("event_time")).write.partitionBy("day").parquet(path)
    silver = spark.read.parquet(path)
    days, redo = J.touched_days(spark, silver, silver)
    assert [str(d) for d in days] == ["2025-01-10"] and redo.count() == 2 and looks.count("touched") == 1


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_koeri_line_is_taken_apart_once(spark):
    page = "<pre>\n2025.01.02 03:04:05  38.1000   30.2000   5.0   -.-  3.1  -.-   SOME PLACE  Revised \n</pre>"
    one = spark.createDataFrame([("KOERI", page.encode(), None, "u")],
                                "source string, content binary, received_at timestamp, archive_uri string")
    rows = parse_koeri_responses(one)
    assert _plan(rows).count("\\s+, 9)") == 1
    assert '"place":"SOME PLACE","quality":"Revised"' in rows.first()["payload"]


def test_events_are_shuffled_not_the_texts_made_of_them(spark):
    path = tempfile.mkdtemp()
    spark.range(600).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "id % 7 AS user_id",
                                "'view' AS event_type", "1.5e0 AS value").coalesce(1).write.parquet(f"{path}/events.parquet")
    responses = fixture_responses(spark, path)
    plan = responses._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate explode") < plan.index("Exchange")
    assert responses.groupBy("source").count().where("count <> 3").isEmpty()


_RAW = "source string, event_id string, payload string, received_at timestamp, archive_uri string, ordinal int"


def _afad(uri, ordinal, mag, lat="40.0"):
    body = f'{{"eventID":1,"date":"2025-01-02T03:04:05","latitude":"{lat}","longitude":"29.0","magnitude":"{mag}"}}'
    return ("AFAD", f"{uri}-{ordinal}-{mag}", body, None, uri, ordinal)


def test_a_report_is_mapped_once(spark):
    """The checks on mapped columns take them as they are."""
    good, _ = quarantine_harmonized(harmonize(spark.createDataFrame([_afad("a", 0, 3.0)], _RAW)))
    checks = [line for line in _plan(good).splitlines() if "Filter" in line]
    assert checks and not any("_p#" in line for line in checks) and good.first()["magnitude"] == 3.0


def test_an_event_id_is_read_once(spark):
    ids = [{"id": "a", "properties": {"unid": "x"}}, {"id": "", "properties": {"unid": "b"}}, {"properties": {"unid": "c"}}, {"id": ""}]
    one = spark.createDataFrame([("EMSC", json.dumps({"features": ids}).encode(), None, "u")],
                                "source string, content binary, received_at timestamp, archive_uri string")
    rows, _ = parse_json_responses(one)
    assert _plan(rows).count("$.properties.unid") == 1
    assert [r.event_id for r in rows.orderBy("ordinal").collect()] == ["a", "b", "c"]


def test_limits_map_rows_once(spark):
    """One mapping and one shuffle; a place goes if nothing mapped there is
    inside, rows without a place or that cannot be mapped stay."""
    rows = [_afad("a", 0, 3.0), _afad("a", 1, 0.5), _afad("b", 0, 0.5), _afad("b", 0, 2.0), _afad(None, 0, 0.5),
            _afad("c", 0, 0.5, lat=""), _afad("d", 0, 0.5), _afad("d", 0, 0.5, lat="")]
    kept = J.within(spark.createDataFrame(rows, _RAW), J.Limits(J.LIVE_MIN_MAG, J.TR_BBOX, {"EMSC": 1, "AFAD": 2}))
    assert _plan(kept).count("from_json") == 1 and _plan(kept).count("Repartition") == 1
    assert sorted((r.archive_uri or "", r.event_id) for r in kept.collect()) == [
        ("", "None-0-0.5"), ("a", "a-0-3.0"), ("b", "b-0-0.5"), ("b", "b-0-2.0"), ("c", "c-0-0.5")]


def test_a_large_day_is_written_by_several_tasks(spark):
    path, size = tempfile.mkdtemp() + "/t", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    table = BatchTable(path, T.StructType([T.StructField("text", T.StringType())]))
    was = spark.conf.get(size)
    spark.conf.set(size, "16k")
    try:
        table.put(spark.range(40_000, numPartitions=8).selectExpr("sha1(string(id)) AS text", "date'2025-01-02' AS day"), "a")
    finally:
        spark.conf.set(size, was)
    files = table.read(spark).select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1 and table.read(spark).count() == 40_000


def test_members_are_shuffled_once_to_facts(spark):
    rows = reports_df(spark, [ev("AFAD", datetime(2025, 1, 10, tzinfo=timezone.utc), 40, 29, 3.0)])
    members = spark.read.parquet(_saved(C.assign_clusters(C.time_sessions(rows))))
    plan = C.build_facts(members)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_reports_are_not_shuffled_to_meet_their_sessions(spark):
    """Nor are their pieces' warm-ups more than a quarter of what is walked for them."""
    start = datetime(2025, 1, 10, tzinfo=timezone.utc)
    rows = spark.read.parquet(_saved(reports_df(spark, [ev("AFAD", start + timedelta(seconds=30 * i), 40, 29, 3.0) for i in range(600)])))
    s = C.time_sessions(rows)
    assert "Exchange hashpartitioning" not in s._jdf.queryExecution().executedPlan().toString()
    pieces = C.piece_table(s.withColumn("block", F.col("session")), 90_000_000, 5, C.PIECE_WARM_UPS * C.WARM_WINDOWS)
    assert 4 * pieces.select("piece").distinct().count() * C.WARM_WINDOWS <= pieces.count() + 4 * C.WARM_WINDOWS


def test_walked_reports_are_written_once(spark):
    rows = reports_df(spark, [ev("AFAD", datetime(2025, 1, 10, tzinfo=timezone.utc), 40, 29, 3.0)])
    walked = C.assign_clusters(C.time_sessions(rows), stored=True)
    assert walked.inputFiles() and "MapInArrow" not in _plan(walked)
    calls = []
    layer = [store.frame(spark, "/none", "walked", lambda: calls.append(1) or walked) for _ in range(2)]
    assert layer == [walked, walked] and len(calls) == 1


def test_documents_carry_their_day(spark):
    """No join of the changes with themselves."""
    facts = spark.createDataFrame([], J.FACT).withColumn("day", F.to_date("event_time"))
    docs = to_documents(facts, "day")
    assert "Join" not in _plan(docs) and docs.columns == [*to_documents(facts).columns, "day"]


def _saved(df) -> str:
    path = tempfile.mkdtemp() + "/t"
    df.write.parquet(path)
    return path


def test_an_increment_writes_payloads_of_refused_rows_only(spark, monkeypatch):
    """Neither the increment nor its known rows are written with their payloads;
    what is refused keeps its own, with the reason."""
    names, kept = {}, J.written
    monkeypatch.setattr(J, "written", lambda s, df, name: names.setdefault(name, kept(s, df, name)))
    store = J.Store(tempfile.mkdtemp() + "/store")
    rows = spark.createDataFrame([_afad("a", 0, 3.0), _afad("a", 1, 2.0), _afad("a", 1, 2.0), _afad("b", 0, 1.0, lat="")], _RAW)
    J.harmonize_batch(rows, "x", store, "2025-02-01")
    assert [n for n, df in names.items() if "payload" in df.columns] == ["harmonized"]
    assert sorted((r.event_id, r.payload is None, r.reason) for r in names["harmonized"].collect()) == [
        ("a-0-3.0", True, None), ("a-1-2.0", True, None), ("b-0-1.0", False, "cannot be mapped")]
    assert store.silver.read(spark).count() == 2 and store.rejected.read(spark).first()["payload"] == rows.collect()[3]["payload"]
    names.clear()
    J.harmonize_batch(rows, "y", store, "2025-02-02")
    assert names["known-keys"].count() == 3 and names["harmonized"].isEmpty() and store.silver.read(spark).count() == 2


def test_rows_of_archived_responses_are_not_shuffled_to_the_log(spark, monkeypatch):
    plans, kept = {}, BatchTable._write

    def write(table, df, dealt=False):
        plans[table.path.rsplit("/", 1)[1]] = dealt
        kept(table, df, dealt)
    monkeypatch.setattr(BatchTable, "_write", write)
    store = J.Store(tempfile.mkdtemp() + "/store")
    body = json.dumps([{"eventID": k, "date": "2025-01-02T03:04:05", "latitude": "40", "longitude": "29"} for k in range(3)]).encode()
    one = spark.createDataFrame([("AFAD", f"s3a://x/{k}.json", datetime(2025, 1, k + 1, tzinfo=timezone.utc), body) for k in range(3)], J.RESPONSE)
    J.ingest_batch(one, "a", store)
    assert plans == {"archive": False, "raw_log": True, "rejected": False}
    files = store.log.read(spark).select(F.input_file_name().alias("f"))
    assert files.count() == 9 and files.distinct().count() == 3 and all(".zstd." in r.f for r in files.collect())
    J.ingest_batch(one, "b", store, J.Limits())  # limits deal rows by response
    assert plans["raw_log"] is False


def test_touched_sessions_are_written_once(spark, monkeypatch):
    """The walk reads the table that the touched sessions stand in."""
    names, kept = [], C.written
    for module in (J, C):
        monkeypatch.setattr(module, "written", lambda s, df, name: names.append(name) or kept(s, df, name))
    store = J.Store(tempfile.mkdtemp() + "/store")
    rows = reports_df(spark, [ev("AFAD", datetime(2025, 1, 10, 12, 0, k, tzinfo=timezone.utc), 40, 29, 3.0) for k in range(3)])
    store.silver.put(rows.withColumn("archive_uri", F.lit("u")).withColumn("harmonized_at", F.lit("2025-01-11").cast("timestamp"))
                     .withColumn("day", F.to_date("event_time")), "a")
    assert J.dedupe_days(spark, store, "a", "2025-01-12").count() == 1
    assert names.count("touched") == 1 and "sessions" not in names
