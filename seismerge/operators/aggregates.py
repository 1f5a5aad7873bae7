"""A1-A10: the aggregations behind the quality checks and dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import SOURCE_PRIORITY
from .filters import lookback_filter


def agreement_histogram(facts: DataFrame) -> DataFrame:
    """A1: fact rows per agreement level (a missing level counts as 1)."""
    lvl = F.coalesce(F.col("agreement_level").cast("int"), F.lit(1))
    return facts.groupBy(lvl.alias("agreement_level")).agg(F.count("*").alias("n_events"))


def agreement_histogram_recent(facts: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """A2: A1 over facts of the last ``hours`` before ``as_of``, ordered by
    level. No rows in the window -> an empty result (the check is skipped)."""
    recent = lookback_filter(facts, "event_time", as_of, hours)
    return (recent.groupBy(F.col("agreement_level").cast("int").alias("agreement_level"))
            .agg(F.count("*").alias("n_events")).orderBy("agreement_level"))


def by_province(facts: DataFrame) -> DataFrame:
    """A3: per non-null province: count, avg magnitude rounded to 2 (half up),
    max magnitude, first and last event; most events first."""
    return (facts.where(F.col("province").isNotNull())
            .groupBy("province")
            .agg(F.count("*").alias("n_events"),
                 F.round(F.avg("magnitude"), 2).alias("avg_magnitude"),
                 F.max("magnitude").alias("max_magnitude"),
                 F.min("event_time").alias("first_event"),
                 F.max("event_time").alias("last_event"))
            .orderBy(F.desc("n_events"), "province"))


def source_freshness(raw: DataFrame, as_of, hours: float = 1.0,
                     sources=SOURCE_PRIORITY) -> DataFrame:
    """A4: raw rows per source received in the last hour, zero counts kept;
    ``silent`` marks sources with none (a warning, not a failure).

    One scan and one grouped count; the zero rows come from a left join of
    the (four-row) list of expected sources, not from a second scan.
    """
    counts = (lookback_filter(raw, "received_at", as_of, hours)
              .groupBy("source").agg(F.count("*").alias("n")))
    names = raw.sparkSession.createDataFrame([(s,) for s in sources], "source string")
    return (names.join(counts, "source", "left")
            .select("source", F.coalesce("n", F.lit(0)).alias("n_rows"),
                    F.coalesce("n", F.lit(0)).__eq__(0).alias("silent")))


def row_conservation(raw: DataFrame, harmonized: DataFrame) -> DataFrame:
    """A5: harmonized rows must not outnumber raw rows (one-row result)."""
    n_h = harmonized.agg(F.count("*")).scalar()
    return (raw.agg(F.count("*").alias("raw_rows"))
            .select("raw_rows", n_h.alias("harmonized_rows"))
            .withColumn("ok", F.col("harmonized_rows") <= F.col("raw_rows")))


def distinct_count(df: DataFrame, col: str = "event_uid", approx: bool = False,
                   rsd: float = 0.05) -> Column:
    """Cardinality of a column; HyperLogLog++ when ``approx``."""
    return F.approx_count_distinct(col, rsd) if approx else F.count_distinct(F.col(col))


def agreement_terms(facts: DataFrame, size: int = 4, approx: bool = False) -> DataFrame:
    """Top levels by unique event_uid; the rest folded into 'other'."""
    per = facts.groupBy(F.col("agreement_level").cast("int").alias("agreement_level")) \
        .agg(distinct_count(facts, approx=approx).alias("n_events"))
    rank = F.row_number().over(Window.orderBy(F.desc("n_events"), "agreement_level"))
    ranked = per.withColumn("rk", rank)
    term = F.when(F.col("rk") <= size, F.col("agreement_level").cast("string")).otherwise("other")
    return ranked.groupBy(term.alias("term")).agg(F.sum("n_events").alias("n_events"))


def province_ranking(facts: DataFrame, size: int = 12, approx: bool = False) -> DataFrame:
    """Top provinces by unique event_uid, missing province excluded."""
    return (facts.where(F.col("province").isNotNull()).groupBy("province")
            .agg(distinct_count(facts, approx=approx).alias("n_events"))
            .orderBy(F.desc("n_events"), "province").limit(size))


def magnitude_over_time(facts: DataFrame, top: int = 4, interval_hours: int = 1) -> DataFrame:
    """Hourly average magnitude per preferred source, empty hours kept.

    Series = the ``top`` sources with the highest overall average, the rest
    folded into 'other'. The facts are read once, into sums per source and
    hour; ranks, bounds, hours and averages all come from that small table.
    The hour spine is generated per series with ``sequence``.
    """
    hourly = facts.groupBy("preferred_source", F.date_trunc("hour", "event_time").alias("hour")).agg(
        F.sum("magnitude").alias("total"), F.count("magnitude").alias("known"), F.count("*").alias("n"))
    of_source = Window.partitionBy("preferred_source")
    average = F.sum("total").over(of_source) / F.nullif(F.sum("known").over(of_source), F.lit(0))
    every = Window.partitionBy(F.lit(0))
    ranked = hourly.withColumn("a", average).select(
        "*", F.dense_rank().over(Window.orderBy(F.desc_nulls_last("a"), "preferred_source")).alias("rk"),
        F.min("hour").over(every).alias("lo"), F.max("hour").over(every).alias("hi"))
    step = F.make_dt_interval(hours=F.lit(interval_hours))
    series = F.when(F.col("rk") <= top, F.col("preferred_source")).otherwise("other").alias("series")
    per_hour = (ranked.groupBy(series, "hour").agg(F.sum("total").alias("total"), F.sum("known").alias("known"),
                                                  F.sum("n").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi")))
    filled = per_hour.groupBy("series").agg(
        F.sequence(F.first("lo"), F.first("hi"), step).alias("hours"),
        F.map_from_entries(F.collect_list(F.struct("hour", F.struct("total", "known", "n").alias("v")))).alias("at"))
    v = F.element_at("at", F.col("hour"))
    return (filled.select("series", "at", F.explode("hours").alias("hour"))
            .select("hour", "series", (v["total"] / F.nullif(v["known"], F.lit(0))).alias("avg_magnitude"),
                    F.coalesce(v["n"], F.lit(0)).alias("n_events")))


def max_watermark(df: DataFrame, col: str, keys: list[str] | None = None) -> DataFrame:
    """A10: the new cursor of an increment (max of its time column)."""
    return df.groupBy(*(keys or [])).agg(F.max(col).alias("watermark"))
