"""Raw payloads -> the canonical report schema (silver).

All four agency mappers run in ONE projection over the raw rows: the payload
is parsed once with a superset schema and each output column is a ``CASE`` on
``source``. No per-source branches, no union, a single scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import afad_time, epoch_ms_time, iso_z_time, koeri_time, to_double_or_null
from ..schemas import SOURCE_PRIORITY

# Every field any agency's mapper reads, as text (numbers may arrive as text).
PAYLOAD_SCHEMA = """
    eventID string, date string, time string, latitude string, longitude string,
    depth string, depth_km string, magnitude string, type string, location string,
    province string, district string, md string, ml string, mw string, place string,
    properties struct<lat: string, lon: string, depth: string, mag: string,
                      magtype: string, time: string,
                      flynn_region: string, place: string>,
    geometry struct<coordinates: array<string>>
"""

# KOERI magnitude scales in order of preference.
KOERI_MAG_PRECEDENCE = ("mw", "ml", "md")

CANONICAL_COLS = ["source", "event_id", "event_time", "latitude", "longitude", "depth_km",
                  "magnitude", "mag_type", "place", "province", "district"]


def _by_source(afad: Column | None, koeri: Column | None, emsc: Column | None,
               usgs: Column | None) -> Column:
    s = F.col("source")
    out = None
    for name, c in (("AFAD", afad), ("KOERI", koeri), ("EMSC", emsc), ("USGS", usgs)):
        if c is None:
            continue
        out = F.when(s == name, c) if out is None else out.when(s == name, c)
    return out


def map_rows(raw: DataFrame, strict: bool = True) -> DataFrame:
    """P6-P10 over raw rows ``(source, event_id, payload, ...)``: the rows as
    they are, with their canonical columns in ``_m`` and, as ``_m._ok``,
    whether a mapper takes them (it refuses rows without coordinates; of KOERI
    without date/time or with an unparsable one; of USGS with fewer than two
    coordinates). ``strict`` fails the job on an unknown source name (P10);
    otherwise such rows are not taken.
    """
    p = F.col("_p")
    props = p["properties"]
    coords = p["geometry"]["coordinates"]
    # The first scale present wins, then its value is converted (a malformed
    # value gives null rather than falling through to the next scale).
    koeri_mag = to_double_or_null(F.coalesce(*[p[m] for m in KOERI_MAG_PRECEDENCE]))
    koeri_type = F.coalesce(*[F.when(p[m].isNotNull(), F.lit(m.upper()))
                              for m in KOERI_MAG_PRECEDENCE])
    src = F.col("source")
    if strict:
        src = F.when(src.isin(*SOURCE_PRIORITY), src) \
            .otherwise(F.raise_error(F.concat(F.lit("unknown source: "), F.coalesce(src, F.lit("NULL")))))
    # Field names resolve case-insensitively, so USGS ``magType`` (EMSC has
    # ``magtype``) is read by path instead of through the schema.
    # Parsed once per row: a one-element explode makes the record a generator
    # output, which later projections reference instead of re-parsing JSON
    # for every field they read.
    df = raw.withColumn("source", src) \
        .select("*", F.explode(F.array(F.from_json("payload", PAYLOAD_SCHEMA))).alias("_p"))
    lat = _by_source(to_double_or_null(p["latitude"]), to_double_or_null(p["latitude"]),
                     to_double_or_null(props["lat"]), to_double_or_null(F.try_element_at(coords, F.lit(2))))
    lon = _by_source(to_double_or_null(p["longitude"]), to_double_or_null(p["longitude"]),
                     to_double_or_null(props["lon"]), to_double_or_null(F.try_element_at(coords, F.lit(1))))
    koeri_ok = (F.coalesce(p["date"], F.lit("")) != "") & (F.coalesce(p["time"], F.lit("")) != "")
    k_time = koeri_time(p["date"], p["time"])
    ok = (lat.isNotNull() & lon.isNotNull()
          & _by_source(F.lit(True), koeri_ok & k_time.isNotNull(), F.lit(True),
                       F.coalesce(F.size(coords), F.lit(0)) >= 2))
    fields = F.struct(
        _by_source(afad_time(F.coalesce(p["date"], F.lit(""))), k_time, iso_z_time(props["time"]),
                   epoch_ms_time(props["time"])).alias("event_time"),
        lat.alias("latitude"), lon.alias("longitude"),
        _by_source(to_double_or_null(p["depth"]), to_double_or_null(p["depth_km"]),
                   to_double_or_null(props["depth"]),
                   to_double_or_null(F.try_element_at(coords, F.lit(3)))).alias("depth_km"),
        _by_source(to_double_or_null(p["magnitude"]), koeri_mag, to_double_or_null(props["mag"]),
                   to_double_or_null(props["mag"])).alias("magnitude"),
        _by_source(p["type"], koeri_type, props["magtype"],
                   F.get_json_object("payload", "$.properties.magType")).alias("mag_type"),
        _by_source(p["location"], p["place"], props["flynn_region"], props["place"]).alias("place"),
        _by_source(p["province"], None, None, None).alias("province"),
        _by_source(p["district"], None, None, None).alias("district"),
        ok.alias("_ok"))
    # As above: a filter on a mapped column takes it as it is; it would
    # otherwise map the row a second time.
    return df.withColumn("_m", fields).select(*raw.columns, F.explode(F.array("_m")).alias("_m"))


def map_canonical(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The rows that a mapper takes (see ``map_rows``); extra input columns are
    carried through."""
    extra = [c for c in raw.columns if c not in ("source", "event_id", "payload")]
    return map_rows(raw, strict).where(F.col("_m._ok")).select(
        "source", "event_id", *[F.col(f"_m.{c}") for c in CANONICAL_COLS[2:]], *extra)


def harmonize(raw: DataFrame, as_of=None, strict: bool = True) -> DataFrame:
    """Raw rows -> harmonized rows (canonical + archive_uri + harmonized_at)."""
    c = map_canonical(raw, strict=strict)
    ts = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    keep = [x for x in c.columns if x not in CANONICAL_COLS]
    return c.select(*CANONICAL_COLS, *keep, ts.alias("harmonized_at"))
