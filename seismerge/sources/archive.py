"""The response archive and the raw (bronze) table.

Archive layout on the shared store: ``<root>/<SOURCE>/<YYYY-MM-DD>/<HHMMSS>-<id8>.<ext>``.
Landed files are read with the ``binaryFile`` source; source, day and
extension are parsed from the path, so a source filter prunes by directory.
The archive can also be kept as a Parquet table partitioned by
(source, day) with the bytes in ``content``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import SOURCE_PRIORITY

DEFAULT_REPLAY_SOURCES = "AFAD,EMSC,USGS"

_PATH_RE = r"/([A-Za-z]+)/(\d{4}-\d{2}-\d{2})/([^/]+)\.(json|html)$"


def selected_sources(spec: str | None = None) -> list[str]:
    """The source scope: a comma list, trimmed and upper-cased."""
    spec = DEFAULT_REPLAY_SOURCES if spec is None else spec
    return sorted({s.strip().upper() for s in spec.split(",") if s.strip()})


def scan_archive(spark: SparkSession, root: str, sources: list[str] | str | None = None,
                 received_at=None) -> DataFrame:
    """Every landed response under ``root`` for the chosen sources.

    Output: (source, day, ext, archive_uri, received_at, content).
    ``received_at`` defaults to the file's modification time.
    """
    srcs = selected_sources(sources) if isinstance(sources, str) or sources is None else sources
    # Whole source folders, listed by Spark; a source that never landed
    # anything has none and is skipped.
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folders = [f"{root.rstrip('/')}/{s}" for s in srcs]
    there = [f for f in folders if (p := jvm.org.apache.hadoop.fs.Path(f)).getFileSystem(conf).exists(p)]
    if not there:
        return spark.createDataFrame([], "source string, day string, ext string, archive_uri string, "
                                         "received_at timestamp, content binary")
    path = F.col("path")
    out = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there)).select(
        F.regexp_extract(path, _PATH_RE, 1).alias("source"),
        F.regexp_extract(path, _PATH_RE, 2).alias("day"),
        F.regexp_extract(path, _PATH_RE, 4).alias("ext"),
        path.alias("archive_uri"),
        (F.lit(received_at).cast("timestamp") if received_at is not None
         else F.col("modificationTime")).alias("received_at"),
        F.col("content"))
    # A file whose path does not fit the layout has no source; the parser
    # quarantines it.
    return out.where(F.col("source").isin(*SOURCE_PRIORITY, ""))


def archive_sink(responses: DataFrame, path: str) -> None:
    """S12 (table form): append responses, unchanged, partitioned by
    (source, day). Append-only: nothing is ever rewritten."""
    (responses.withColumn("day", F.date_format("received_at", "yyyy-MM-dd"))
     .select("source", "day", "archive_uri", "received_at", "content")
     .write.mode("append").partitionBy("source", "day").parquet(path))


def scan_archive_table(spark: SparkSession, path: str, sources: list[str] | str | None = None
                       ) -> DataFrame:
    """S1 over the table form of the archive: the source filter is a
    partition filter, so other agencies' folders are never listed."""
    srcs = selected_sources(sources) if isinstance(sources, str) or sources is None else sources
    return (spark.read.parquet(path).where(F.col("source").isin(*srcs))
            .select("source", "day", "archive_uri", "received_at", "content"))


def raw_sink(raw: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw rows as Parquet by source and day of receipt, so that checks of
    recent rows and increments open recent files only."""
    (raw.select("source", "event_id", "payload", "received_at", "archive_uri")
     .withColumn("day", F.to_date("received_at")).repartition("source", "day")
     .write.mode(mode).partitionBy("source", "day").parquet(path))
