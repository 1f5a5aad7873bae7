"""The layer tables (bronze raw, silver harmonized, clustered members, gold
facts) written once per session to the shared folder named by
``spark.checkpoint.dir`` and read back as Parquet.

This is the medallion layout of the engine: jobs build a layer from the one
below and write it; views and checks scan the written tables, so each
reads only the columns and day partitions it needs (pushed filters, pruned
schema) and no query recomputes the layers below. A written table also cuts
the lineage: losing an executor never replays the whole pipeline.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import CODEC, checkpoint_dir

_LOCK = threading.RLock()  # a layer build reads the layers below it
_BUILT: dict[tuple[str, str, str], str] = {}
_FRAMES: dict[tuple[str, str, str], DataFrame] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir.rstrip("/"), name


def table(spark: SparkSession, sf_dir: str, name: str, build, partition_by: list[str] | None = None,
          sort_by: list[str] | None = None) -> DataFrame:
    """Read layer ``name`` for ``sf_dir``, building it first if needed."""
    k = _key(spark, sf_dir, name)
    with _LOCK:
        path = _BUILT.get(k)
        if path is None:
            tag = hashlib.sha1("|".join(k).encode()).hexdigest()[:12]
            path = f"{checkpoint_dir(spark)}/layers-{tag}/{name}"
            df = build()
            if sort_by:
                df = df.sortWithinPartitions(*sort_by)
            w = df.write.mode("overwrite").option("compression", CODEC)
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
            _BUILT[k] = path
    return spark.read.parquet(path)


def frame(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Layer ``name`` as ``build`` leaves it: a frame over tables it wrote
    itself, which are not written a second time."""
    k = _key(spark, sf_dir, name)
    with _LOCK:
        if k not in _FRAMES:
            _FRAMES[k] = build()
    return _FRAMES[k]


def built_layers() -> dict:
    return dict(_BUILT)


def with_day(df: DataFrame, col: str = "event_time") -> DataFrame:
    """A ``day`` partition column so time predicates prune whole files."""
    return df.withColumn("day", F.to_date(col))
