"""Adapter from the driver's ``events`` table to four agency feeds.

The driver tables hold no earthquake data, so reports are derived from
``events`` with integer arithmetic that DuckDB reproduces bit for bit
(see ``oracle.py``). Each event yields one to four reports (one per agency),
with deliberate time, distance and magnitude splits. The reports are then
rendered in each agency's own response format (AFAD JSON list or
``{"result": [...]}``, EMSC and USGS GeoJSON, KOERI HTML ``<pre>`` page) so
the parsers and mappers run on real-shaped payloads.

Everything here is a narrow DataFrame pipeline: a fan-out by ``explode``
(no cross join) and one bounded aggregation per archived response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalar import LATIN1_SAME_BYTES, LATIN5_LETTERS, py_fixed
from ..schemas import SOURCE_PRIORITY

# Reports per archived response: one response groups the reports of
# BLOB_EVENTS consecutive event ids, so every response is bounded.
BLOB_EVENTS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _published_time(k: Column, t: Column) -> Column:
    """Precision each agency publishes: AFAD microseconds, KOERI whole
    seconds, EMSC and USGS milliseconds."""
    return (F.when(k == 0, t)
            .when(k == 1, F.date_trunc("second", t))
            .otherwise(F.timestamp_millis(F.unix_millis(t))))


def fixture_reports(events: DataFrame, published: bool = True) -> DataFrame:
    """Canonical reports derived from ``events`` (the rule of SURVEY §7.2).

    ``published=False`` keeps full microsecond times for every agency.
    Extra columns: ``k`` (agency index), ``eid`` (event id), ``user_id``,
    ``event_type`` for the renderers.
    """
    e = events.select("event_id", "ts", "user_id", "event_type", "value")
    r = (e.select("*", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("k"))
         .where((F.col("k") + F.col("event_id")) % 4 <= F.floor(F.col("event_id") / 4) % 4))
    k, eid, uid = F.col("k"), F.col("event_id"), F.col("user_id")
    t = (F.col("ts").cast("timestamp")
         + F.make_dt_interval(secs=(k * 4 + F.when((eid % 23 == 0) & (k == 1), 95).otherwise(0))
                              .cast("decimal(18,6)")))
    if published:
        t = _published_time(k, t)
    lat = (F.lit(3550) + (uid * 37 + eid * 11) % 700 + k
           + F.when((eid % 17 == 0) & (k == 3), 100).otherwise(0)) / F.lit(100e0)
    lon = (F.lit(2550) + (uid * 53 + eid * 29) % 1950 + k) / F.lit(100e0)
    mag = F.when(eid % 41 == 0, F.lit(None).cast("double")).otherwise(
        (F.lit(10) + eid % 50 + k + F.when((eid % 19 == 0) & (k == 2), 20).otherwise(0)) / F.lit(10e0))
    src = F.element_at(F.array(*[F.lit(s) for s in SOURCE_PRIORITY]), k + 1)
    koeri_depth = py_fixed(F.col("value"), 1).cast("double")
    # KOERI line carries md/ml/mw; the mapper picks mw > ml > md.
    koeri_type = F.when(mag.isNull(), None).when(eid % 3 == 0, "MW").when(eid % 3 == 1, "ML") \
        .otherwise("MD")
    mag_type = (F.when(k == 0, F.lit("ML")).when(k == 1, koeri_type)
                .when(k == 2, F.when(eid % 2 == 0, "mb").otherwise("ML"))
                .otherwise(F.when(eid % 2 == 0, "mww").otherwise("mb")))
    ev_id = (F.when(k == 0, eid.cast("string"))
             .when(k == 2, F.concat(F.lit("emsc-"), eid.cast("string")))
             .when(k == 3, F.concat(F.lit("us"), F.lpad(eid.cast("string"), 8, "0"))))
    out = r.select(
        src.alias("source"),
        ev_id.alias("event_id"),
        t.alias("event_time"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.when(k == 1, koeri_depth).otherwise(F.col("value")).alias("depth_km"),
        mag.alias("magnitude"),
        mag_type.alias("mag_type"),
        F.when((k == 1) & (eid % 4 == 2),
               F.concat(F.rpad(F.concat(F.lit("zone "), uid.cast("string")), 40, " "),
                        F.lit(" İlksel")))
        .otherwise(F.concat(F.lit("zone "), uid.cast("string"))).alias("place"),
        F.when(k == 0, F.col("event_type")).alias("province"),
        F.when(k == 0, F.concat(F.lit("district "), (uid % 7).cast("string"))).alias("district"),
        k.alias("k"), eid.alias("eid"),
        F.concat(F.lit("zone "), uid.cast("string")).alias("base_place"),
    )
    # KOERI has no agency id: the parser derives it from the published line.
    koeri_id = F.format_string("KOERI-%sT%s-%s-%s",
                               F.date_format(F.col("event_time") + F.expr("INTERVAL 3 HOURS"),
                                             "yyyy-MM-dd"),
                               F.date_format(F.col("event_time") + F.expr("INTERVAL 3 HOURS"),
                                             "HH:mm:ss"),
                               py_fixed(F.col("latitude"), 3), py_fixed(F.col("longitude"), 3))
    return out.withColumn("event_id", F.when(F.col("k") == 1, koeri_id).otherwise(F.col("event_id")))


CANONICAL_COLS = ["source", "event_id", "event_time", "latitude", "longitude", "depth_km",
                  "magnitude", "mag_type", "place", "province", "district"]


def canonical_reports(spark: SparkSession, sf_dir: str, published: bool = True) -> DataFrame:
    return fixture_reports(read_table(spark, sf_dir, "events"), published).select(*CANONICAL_COLS)


# --- rendering of agency responses ----------------------------------------

def render_responses(reports: DataFrame) -> DataFrame:
    """One row per archived response: (source, blob, ext, received_at,
    archive_uri, content binary). ``reports`` is ``fixture_reports(...)``.

    Each report is rendered to its element text first (a JSON object, or a
    KOERI line); then ONE aggregation per (agency, response) joins the
    sorted elements and wraps them in the agency's envelope. Responses hold
    at most BLOB_EVENTS events, so every group is bounded.
    """
    r = reports.withColumn("blob", F.floor(F.col("eid") / BLOB_EVENTS))
    t = F.col("event_time")
    k = F.col("k")
    eid = F.col("eid")

    afad_item = F.struct(
        F.col("eid").alias("eventID"),
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("date"),
        F.col("latitude").cast("string").alias("latitude"),       # AFAD sends numbers as text
        F.col("longitude").cast("string").alias("longitude"),
        F.col("depth_km").alias("depth"),
        F.col("magnitude").cast("string").alias("magnitude"),
        F.col("mag_type").alias("type"),
        F.col("place").alias("location"),
        F.col("province").alias("province"),
        F.col("district").alias("district"),
    )
    emsc_feat = F.struct(
        F.lit("Feature").alias("type"),
        F.when(eid % 7 == 0, F.lit("")).otherwise(F.col("event_id")).alias("id"),
        F.struct(F.col("event_id").alias("unid"),
                 F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
                 F.col("depth_km").alias("depth"), F.col("magnitude").alias("mag"),
                 F.col("mag_type").alias("magtype"),
                 F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("time"),
                 F.col("place").alias("flynn_region")).alias("properties"),
    )
    usgs_feat = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("magnitude").alias("mag"), F.col("place").alias("place"),
                 F.unix_millis(t).alias("time"), F.col("mag_type").alias("magType"),
                 F.lit("earthquake").alias("type")).alias("properties"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(F.col("longitude"), F.col("latitude"), F.col("depth_km"))
                 .alias("coordinates")).alias("geometry"),
        F.col("event_id").alias("id"),
    )

    # KOERI: local time (UTC+3), '-.-' for a missing magnitude, quality tag.
    local = t + F.expr("INTERVAL 3 HOURS")
    m = F.col("magnitude")
    fmt_m = lambda c: F.coalesce(py_fixed(c, 1), F.lit("-.-"))
    md = F.when(eid % 3 == 2, m).when(eid % 3 == 1, m + F.lit(0.1e0))
    ml = F.when(eid % 3 == 1, m).when(eid % 3 == 0, m - F.lit(0.2e0))
    mw = F.when(eid % 3 == 0, m)
    # Only manual/automatic/auto/revised (any case) are split off as a tag;
    # any other trailing word stays part of the place.
    quality = F.when(eid % 4 == 0, "Manual").when(eid % 4 == 1, "REVISED") \
        .when(eid % 4 == 2, "İlksel").otherwise("")
    line = F.concat_ws(" ",
                       F.date_format(local, "yyyy.MM.dd"), F.date_format(local, "HH:mm:ss"),
                       F.lpad(py_fixed(F.col("latitude"), 4), 8, " "),
                       F.lpad(py_fixed(F.col("longitude"), 4), 9, " "),
                       F.lpad(py_fixed(F.col("depth_km"), 1), 10, " "),
                       F.lpad(fmt_m(md), 6, " "), F.lpad(fmt_m(ml), 4, " "), F.lpad(fmt_m(mw), 4, " "),
                       F.rpad(F.col("base_place"), 40, " "), quality)
    header = ("Tarih      Saat      Enlem(N)  Boylam(E) Derinlik(km)  MD   ML   Mw    Yer"
              "                                             Cozum Niteligi\n"
              "---------- --------  --------  -------   ----------    ------------    "
              "--------------\n")

    elem = (F.when(k == 0, F.to_json(afad_item)).when(k == 1, line)
            .when(k == 2, F.to_json(emsc_feat)).otherwise(F.to_json(usgs_feat)))
    # JSON feeds list events by id; the KOERI page lists the newest first.
    order = F.when(k == 1, -F.unix_micros(t)).otherwise(eid)
    grouped = r.groupBy("k", "blob").agg(
        F.sort_array(F.collect_list(F.struct(order.alias("o"), elem.alias("e")))).alias("items"),
        F.max("event_time").alias("newest"))
    src = F.element_at(F.array(*[F.lit(x) for x in SOURCE_PRIORITY]), k + 1)
    body_json = F.array_join(F.col("items.e"), ",")
    text = (F.when(k == 0, F.when(F.col("blob") % 2 == 0,
                                  F.concat(F.lit("["), body_json, F.lit("]")))
                   .otherwise(F.concat(F.lit('{"result":['), body_json, F.lit("]}"))))
            .when(k == 1, F.concat(F.lit("<HTML><HEAD><TITLE>Son Depremler</TITLE></HEAD><BODY>\n"
                                         "<PRE>\nRECENT EARTHQUAKES IN TURKEY\n\n" + header),
                                   F.array_join(F.col("items.e"), "\n"),
                                   F.lit("\n</PRE></BODY></HTML>\n")))
            .otherwise(F.concat(F.lit('{"type":"FeatureCollection","features":['), body_json,
                                F.lit("]}"))))
    # received_at = pull time (two minutes after the newest report, to the
    # minute); archive_uri = <source>/<day>/<HHMMSS>-<8 hex>.<ext>.
    fetched = F.date_trunc("minute", F.col("newest")) + F.expr("INTERVAL 2 MINUTES")
    ext = F.when(k == 1, "html").otherwise("json")
    key = F.substring(F.sha1(F.concat_ws("|", src, F.col("blob").cast("string"))), 1, 8)
    uri = F.concat(F.lit("s3a://archive/"), src, F.lit("/"), F.date_format(fetched, "yyyy-MM-dd"),
                   F.lit("/"), F.date_format(fetched, "HHmmss"), F.lit("-"), key, F.lit("."), ext)
    # KOERI pages are ISO-8859-9 (Latin-5). It differs from Latin-1 in six
    # letters only, so map those onto their Latin-1 code points and encode.
    content = F.when(k == 1, F.encode(F.translate(text, LATIN5_LETTERS, LATIN1_SAME_BYTES),
                                      "ISO-8859-1")).otherwise(F.encode(text, "UTF-8"))
    return grouped.select(src.alias("source"), "blob", ext.alias("ext"),
                          fetched.alias("received_at"), uri.alias("archive_uri"),
                          content.alias("content"))


def fixture_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # By response before the reports are rendered: ``events`` may be one file
    # that few tasks can read, and the rendered texts are not shuffled.
    events = read_table(spark, sf_dir, "events").repartition(F.floor(F.col("event_id") / BLOB_EVENTS))
    return render_responses(fixture_reports(events))
