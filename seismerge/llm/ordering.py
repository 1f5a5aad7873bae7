"""Positions within sorted groups of any size, and sorted groups as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seismerge.llm.common import written

#: monotonically_increasing_id holds the row's place in its partition in these low bits.
PLACE_BITS = 33


def ranked(spark: SparkSession, table: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``table`` (a written table) with ``pos``, a row's place from 0 within its
    group by ``order`` (nulls first), and ``size``, the group's rows.

    Rows are sorted over range partitions of (group, order), so a group that
    holds a third of them is spread over tasks like any other. A partition's
    run of a group is numbered by the sort itself; the runs, at most one a
    partition and group, are added up per group. Give ``order`` a column that
    tells rows apart, for splits to be possible in any case. Null is a group.
    """
    keys = [F.col(c).asc_nulls_first() for c in [group, *order]]
    part = F.shiftright("ranked_at", PLACE_BITS)
    at = written(spark, table.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumn("ranked_at", F.monotonically_increasing_id()), "sorted")
    runs = at.groupBy(F.col(group).alias("ranked_group"), part.alias("ranked_part")).agg(
        F.min("ranked_at").alias("first"), F.count("*").alias("rows"))
    own = Window.partitionBy("ranked_group")
    runs = written(spark, runs.select(
        "ranked_group", "ranked_part", F.sum("rows").over(own).alias("size"),
        (F.sum("rows").over(own.orderBy("ranked_part")) - F.col("rows") - F.col("first")).alias("ranked_shift")), "runs")
    return (at.join(runs, F.col(group).eqNullSafe(F.col("ranked_group")) & (part == F.col("ranked_part")))
            .withColumn("pos", F.col("ranked_at") + F.col("ranked_shift"))
            .drop("ranked_at", "ranked_group", "ranked_part", "ranked_shift"))


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows with equal keys, as (key, rows); groups must be small."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            k = tuple(row[c] for c in keys)
            if k != key and rows:
                yield key, rows
                rows = []
            key = k
            rows.append(row)
    if rows:
        yield key, rows


def batched(rows: Iterator[tuple], schema: pa.Schema, limit: int = 2000) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most ``limit`` rows."""
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) == limit:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
