"""O1, O2, U7 and the serving views over the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LATEST_COLUMNS = ["event_time", "magnitude", "mag_type", "depth_km", "province", "district",
                  "place", "agreement_level", "sources", "preferred_source", "latitude",
                  "longitude"]


def latest_events(facts: DataFrame, n: int = 500) -> DataFrame:
    """O1: newest n events (top-k, planned as TakeOrderedAndProject)."""
    return facts.orderBy(F.desc("event_time"), F.desc("event_uid")).limit(n) \
        .select(*LATEST_COLUMNS, "event_uid")


def disagreement(facts: DataFrame, n: int = 500) -> DataFrame:
    """O2: events confirmed by two or more agencies, newest n."""
    return (facts.where(F.col("agreement_level") >= 2)
            .orderBy(F.desc("event_time"), F.desc("event_uid")).limit(n)
            .select("event_uid", "event_time", F.col("magnitude").alias("preferred_magnitude"),
                    "preferred_source", "agreement_level", "sources", "source_values"))


def drilldown(facts: DataFrame) -> DataFrame:
    """One row per (fact, agency) from ``source_values``, no re-join."""
    return facts.select("event_uid", F.explode("source_values").alias("source", "v")) \
        .select("event_uid", "source", "v.*")
