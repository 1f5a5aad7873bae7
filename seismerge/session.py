"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session time (all event times are UTC),
# adaptive execution (runtime broadcast of small sides, skew-join splitting,
# partition coalescing) and Arrow for the few Python stages.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM compiles no method of more bytes, so such a stage is generated in smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Of the files of all tables: payloads take about two thirds of what they do by the default.
CODEC = "zstd"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "seismerge", extra: dict | None = None,
              driver_memory: str | None = "16g") -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local") and driver_memory:
        # Local mode runs every task in the driver JVM.
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a reused session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only when it is unset
    (local runs and tests) do we make our own under the system temp folder.
    On a cluster that folder would be each machine's own, so there it is an
    error not to name one.
    """
    d = (spark.conf.get("spark.checkpoint.dir", None)
         or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
         or spark.sparkContext.getCheckpointDir())
    if not d and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="seismerge-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # some builds refuse runtime changes of core settings
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(spark: SparkSession, df, name: str):
    """Cut lineage: ``df`` as a table in the shared folder, read back."""
    path = scratch_path(spark, name)
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
