"""Q1-Q4: data-quality checks as DataFrames (split good rows from a
quarantine with a reason instead of failing the whole batch)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import SOURCE_PRIORITY
from .canonical import CANONICAL_COLS, map_rows


def _reason(checks: list[tuple[Column, str]]) -> Column:
    """First failing check's label, or null when the row passes."""
    out = None
    for bad, label in checks:
        out = F.when(bad, F.lit(label)) if out is None else out.when(bad, F.lit(label))
    return out


def not_null_checks(cols: list[str]) -> list[tuple[Column, str]]:
    """Q1: NOT NULL columns."""
    return [(F.col(c).isNull(), f"{c} is null") for c in cols]


def domain_checks(kind: str) -> list[tuple[Column, str]]:
    """Q2: source in the four agencies (silver), level in 1..4 (gold)."""
    if kind == "harmonized":
        return [(~F.col("source").isin(*SOURCE_PRIORITY), "unknown source")]
    if kind == "fact":
        return [(~F.col("agreement_level").between(1, len(SOURCE_PRIORITY)),
                 "agreement_level out of range")]
    return []


HARMONIZED_REQUIRED = ["source", "event_id", "event_time", "latitude", "longitude"]
FACT_REQUIRED = ["event_uid", "event_time", "latitude", "longitude", "preferred_source",
                 "agreement_level", "sources", "source_values", "first_seen_at"]


def split_quality(df: DataFrame, checks: list[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with a ``reason`` column)."""
    tagged = df.withColumn("_reason", _reason(checks))
    good = tagged.where(F.col("_reason").isNull()).drop("_reason")
    bad = tagged.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return good, bad


def quarantine_harmonized(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_quality(df, not_null_checks(HARMONIZED_REQUIRED) + domain_checks("harmonized"))


def judge(raw: DataFrame, as_of=None) -> DataFrame:
    """``harmonize`` and ``quarantine_harmonized`` in one pass: every raw row with
    its canonical columns and, if it cannot be used, a ``reason``; those rows
    alone keep ``payload`` and ``received_at``."""
    mapped = map_rows(raw)
    fields = [F.col(f"_m.{c}").alias(c) for c in CANONICAL_COLS[2:]]
    at = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    rows = mapped.select("source", "event_id", *fields, "archive_uri", at.alias("harmonized_at"), "payload", "received_at",
                         F.coalesce("_m._ok", F.lit(False)).alias("_ok"))
    # A row without a key has no other reason: none can be looked up by it.
    checks = [(~F.col("_ok") | F.col("event_id").isNull(), "cannot be mapped"), *not_null_checks(HARMONIZED_REQUIRED), *domain_checks("harmonized")]
    rows = rows.withColumn("reason", _reason(checks)).drop("_ok")
    refused = {c: F.when(F.col("reason").isNotNull(), F.col(c)) for c in ("payload", "received_at")}
    return rows.withColumns(refused)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q3: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def quality_report(raw: DataFrame, harmonized: DataFrame, facts: DataFrame, as_of) -> DataFrame:
    """Q4: independent checks as rows (check, metric, value, status).

    Each check is its own small aggregate; one failing does not hide the
    others. ``status`` is ok / warn / fail.
    """
    from .aggregates import agreement_histogram_recent, source_freshness

    fresh = source_freshness(raw, as_of).select(
        F.lit("sources_seen_recently").alias("check"), F.col("source").alias("metric"),
        F.col("n_rows").cast("bigint").alias("value"),
        F.when(F.col("silent"), "warn").otherwise("ok").alias("status"))
    n_raw = raw.agg(F.count("*").alias("v"))
    n_h = harmonized.agg(F.count("*")).scalar()
    conservation = n_raw.select(
        F.lit("no_orphan_harmonized").alias("check"), F.lit("harmonized_rows").alias("metric"),
        n_h.alias("value"),
        F.when(n_h <= F.col("v"), "ok").otherwise("fail").alias("status"))
    hist = agreement_histogram_recent(facts, as_of).select(
        F.lit("agreement_distribution").alias("check"),
        F.concat(F.lit("level_"), F.col("agreement_level").cast("string")).alias("metric"),
        F.col("n_events").cast("bigint").alias("value"), F.lit("ok").alias("status"))

    def violations(df, checks, name):
        return (df.select(_reason(checks).alias("r")).where(F.col("r").isNotNull())
                .groupBy("r").agg(F.count("*").alias("value"))
                .select(F.lit(name).alias("check"), F.col("r").alias("metric"),
                        F.col("value").cast("bigint"), F.lit("fail").alias("status")))
    nn = violations(harmonized, not_null_checks(HARMONIZED_REQUIRED) + domain_checks("harmonized"),
                    "harmonized_constraints")
    fc = violations(facts, not_null_checks(FACT_REQUIRED) + domain_checks("fact"), "fact_constraints")
    dup = (duplicate_keys(harmonized, ["source", "event_id"]).agg(F.count("*").alias("value"))
           .where(F.col("value") > 0)
           .select(F.lit("unique_key").alias("check"), F.lit("harmonized(source,event_id)").alias("metric"),
                   F.col("value").cast("bigint"), F.lit("fail").alias("status")))
    return reduce(DataFrame.unionByName, [fresh, conservation, hist, nn, fc, dup])
