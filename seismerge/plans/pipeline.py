"""The windowed dedupe job and the fixture's "now". Jobs take an ``as_of``
timestamp instead of calling ``current_timestamp()``, so a re-run reproduces
its output. The layers themselves are built in ``queries.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.cluster import dedupe
from ..operators.filters import lookback_filter
from ..sources.testdata import read_table

DEDUPE_WINDOW_DAYS = 30


def fixture_as_of(spark: SparkSession, sf_dir: str) -> Column:
    """The fixture's "now": the newest event time, as a scalar subquery."""
    return read_table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).scalar()


def fixture_as_of_literal(spark: SparkSession, sf_dir: str) -> str:
    """The same "now" as a literal (one scalar fetched), for jobs whose
    time predicates should reach the Parquet scan and prune day partitions,
    as a scheduled job's ``as_of`` does."""
    v = read_table(spark, sf_dir, "events").agg(
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    return v


def dedupe_window(harmonized: DataFrame, as_of, days: int = DEDUPE_WINDOW_DAYS,
                  scan: str = "creation_break") -> DataFrame:
    """C11: cluster the reports of the last ``days`` (``>=`` cutoff)."""
    recent = lookback_filter(harmonized, "event_time", as_of, days * 24, inclusive=True)
    return dedupe(recent, as_of=as_of, scan=scan)
