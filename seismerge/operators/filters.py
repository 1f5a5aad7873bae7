"""Filters, limits and ordering used by ingestion and
the serving layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The Türkiye bounding box applied to the global feeds.
TR_BBOX = {"min_lat": 35.5, "max_lat": 42.5, "min_lon": 25.5, "max_lon": 45.0}
BBOX_SOURCES = ("EMSC", "USGS")

# Per-source magnitude floors (live pulls; historical default).
LIVE_MIN_MAG = {"AFAD": 1.0, "EMSC": 0.0, "USGS": 2.5}
HISTORICAL_MIN_MAG = 1.0
HISTORICAL_FLOOR = {"EMSC": 1.5, "USGS": 2.5}

# Response caps per pull (EMSC, USGS, and the flow's own).
RESPONSE_CAP = {"EMSC": 5000, "USGS": 20000}
FLOW_CAP = 50


def in_bbox(bbox: dict = TR_BBOX, sources=BBOX_SOURCES) -> Column:
    """The bounding box, on the global feeds only (AFAD and KOERI are
    national and pass unfiltered, as in the reference)."""
    inside = (F.col("latitude").between(bbox["min_lat"], bbox["max_lat"])
              & F.col("longitude").between(bbox["min_lon"], bbox["max_lon"]))
    return ~F.col("source").isin(*sources) | inside


def bbox_filter(df: DataFrame, bbox: dict = TR_BBOX, sources=BBOX_SOURCES) -> DataFrame:
    """P15 (``in_bbox``)."""
    return df.where(in_bbox(bbox, sources))


def historical_floors(min_mag: float = HISTORICAL_MIN_MAG) -> dict:
    return {"AFAD": min_mag, "EMSC": max(min_mag, HISTORICAL_FLOOR["EMSC"]),
            "USGS": max(min_mag, HISTORICAL_FLOOR["USGS"])}


def above_floor(floors: dict = LIVE_MIN_MAG) -> Column:
    """Per-source floor as an inline CASE (the floor table is a handful
    of constants, so no join). Sources without a floor pass; a null
    magnitude fails a floor, as an API ``minmag`` query would."""
    floor = None
    for s, v in floors.items():
        floor = F.when(F.col("source") == s, F.lit(float(v))) if floor is None \
            else floor.when(F.col("source") == s, F.lit(float(v)))
    return floor.isNull() | (F.col("magnitude") >= floor)


def min_magnitude_filter(df: DataFrame, floors: dict = LIVE_MIN_MAG) -> DataFrame:
    """P16 (``above_floor``)."""
    return df.where(above_floor(floors))


def lookback_filter(df: DataFrame, col: str, as_of, hours: float, inclusive: bool = False) -> DataFrame:
    """``col > as_of - interval`` (``>=`` for the dedupe window)."""
    a = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    since = a - F.make_dt_interval(secs=F.lit(int(hours * 3600)))
    out = df.where(F.col(col) >= since if inclusive else F.col(col) > since)
    if "day" in df.columns and not isinstance(as_of, Column):
        # Day-partitioned tables: the same bound on the partition column, so
        # whole day folders are pruned before any file is opened.
        out = out.where(F.col("day") >= F.to_date(since))
    return out


def date_chunks(df: DataFrame, start_col: str, end_col: str, days: int) -> DataFrame:
    """Cover [start, end) with ``days``-long chunks, the last clipped.
    One output row per chunk: (chunk_start, chunk_end) plus input columns."""
    step = F.make_dt_interval(days=F.lit(days))
    starts = F.sequence(F.col(start_col), F.col(end_col) - F.make_dt_interval(secs=F.lit(1e-6)), step)
    return (df.where(F.col(start_col) < F.col(end_col))
            .select("*", F.explode(starts).alias("chunk_start"))
            .withColumn("chunk_end", F.least(F.col("chunk_start") + step, F.col(end_col))))


def sources_filter(df: DataFrame, any_of: list[str] | None = None,
                   all_of: list[str] | None = None) -> DataFrame:
    """Containment on the ``sources`` array."""
    cond = F.lit(True)
    if any_of:
        cond = cond & F.arrays_overlap("sources", F.array(*[F.lit(s) for s in any_of]))
    for s in all_of or []:
        cond = cond & F.array_contains("sources", s)
    return df.where(cond)


MAP_COLUMNS = ["event_uid", "event_time", "latitude", "longitude", "magnitude", "depth_km",
               "place", "preferred_source", "agreement_level"]


def map_view(facts: DataFrame, bbox: dict, t_from, t_to) -> DataFrame:
    """The map layer: bounds + time range, nine tooltip columns; points
    are sized by magnitude and coloured by agreement level."""
    lo, hi = F.lit(t_from).cast("timestamp"), F.lit(t_to).cast("timestamp")
    if "day" in facts.columns:
        facts = facts.where(F.col("day").between(F.to_date(lo), F.to_date(hi)))
    return (facts.where(F.col("latitude").between(bbox["min_lat"], bbox["max_lat"])
                        & F.col("longitude").between(bbox["min_lon"], bbox["max_lon"])
                        & F.col("event_time").between(lo, hi))
            .select(*MAP_COLUMNS))


def among_newest(caps: dict = RESPONSE_CAP, group: list[str] | None = None) -> Column:
    """At most n newest reports per source and pull (``group`` names the
    pull columns). Sources without a cap pass. The window is partitioned by
    source and pull, so each group is one bounded response."""
    keys = ["source"] + (group or [])
    w = Window.partitionBy(*keys).orderBy(F.desc("event_time"), F.desc("event_id"))
    cap = None
    for s, n in caps.items():
        cap = F.when(F.col("source") == s, F.lit(n)) if cap is None else cap.when(F.col("source") == s, F.lit(n))
    return cap.isNull() | (F.row_number().over(w) <= cap)


def response_cap(df: DataFrame, caps: dict = RESPONSE_CAP, group: list[str] | None = None) -> DataFrame:
    """O5 (``among_newest``)."""
    return df.withColumn("_in", among_newest(caps, group)).where("_in").drop("_in")
