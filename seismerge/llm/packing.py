"""Packing into training sequences by the sum-of-squares rule.

Documents become token ids with an end id; only those longer than a sequence
are cut. A piece goes to the open sequence (or a new one) after which the sum
over all gaps of the squared number of open sequences with that gap is
smallest; ties go to the tighter fit. Pieces are dealt at random to buckets
of about ``BUCKET`` pieces, each packed by its own task, so that the work
spreads however many documents there are; a bucket leaves a few sequences
partly open, which is the whole loss against one global packing. Texts and
ids never move: only lengths are shuffled.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.llm.common import prepared, released, slices, with_columns, written
from seismerge.llm.subwords import TOKENIZER, encoder

LENGTH, END_ID, BUCKET = 2048, 0, 16384
#: Text encoded at a time: every byte becomes some eighty bytes of arrays.
PACK_BYTES = 1 << 19


def cut(length: int, tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in slices(batches, limit=PACK_BYTES):
            ids, bounds = encoder(tokenizer).encode(data, off, END_ID)
            size = np.diff(bounds)
            pieces = -(-size // length)
            doc = np.repeat(np.arange(len(size)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * length
            held = np.minimum(length, size[doc] - start)
            raw = memoryview(ids.astype("<u4")).cast("B")
            at = bounds[doc] + start
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + held).tolist())]
            yield with_columns(rows.take(pa.array(doc)), ["doc_id"], piece=piece.astype(np.int32), start=start,
                               length=held, ids_crc32=np.array(crc, np.int64))
        released()
    return run


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, in the given order."""
    far = np.int64(1) << 60
    leave = np.full(capacity + 1, far)  # change when a sequence with this gap is used: 1 - 2n
    reach = np.ones(capacity + 1, np.int64)  # change when one gets this gap: 2n + 1
    reach[0] = 0  # a full sequence is not open
    opened: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, offset, used = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for k, s in enumerate(sizes.tolist()):
        change = leave[s:] + reach[:capacity + 1 - s]
        gap = int(change.argmin()) + s
        if change[gap - s] <= reach[capacity - s]:
            place = opened[gap].pop()
            n = len(opened[gap])
            leave[gap] = 1 - 2 * n if n else far
            reach[gap] = 2 * n + 1
        else:
            place, gap, used = used, capacity, used + 1
        where[k], offset[k] = place, capacity - gap
        gap -= s
        if gap:
            opened[gap].append(place)
            n = len(opened[gap])
            leave[gap], reach[gap] = 1 - 2 * n, 2 * n + 1
    return where, offset


def packer(length: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "at"], ascending=[False, True])
        where, offset = sum_of_squares(rows["length"].to_numpy(), length)
        rows["sequence_id"], rows["offset"] = (key[0] << 32) + where, offset
        return rows.drop(columns=["bucket", "at"])
    return run


def pack(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         tokenizer: str = TOKENIZER, bucket: int = BUCKET) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    prepared(spark)
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = written(spark, docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                     .mapInArrow(cut(length, tokenizer), fields), "pieces")
    buckets = max(1, -(-pieces.count() // bucket))
    at = pieces.withColumn("at", F.monotonically_increasing_id())
    return (at.withColumn("bucket", F.pmod(F.xxhash64("at"), F.lit(buckets))).groupBy("bucket")
            .applyInPandas(packer(length), fields + ", sequence_id long, offset long"))
