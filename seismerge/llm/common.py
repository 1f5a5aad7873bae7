"""Helpers shared by the text operators: intermediate tables in the shared
folder, contract hashing of ids, and numpy views of Arrow text columns."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seismerge.session import scratch_path

#: Text handed to numpy at a time; a longer single document is one slice.
SLICE_BYTES = 2 << 20
ARROW_ROWS = 600


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a table in the shared checkpoint folder
    and read it back, so that any executor can recompute from it. Zstandard
    works on heap buffers; Snappy's direct ones outlive their small files."""
    path = scratch_path(spark, name)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def prepared(spark: SparkSession) -> None:
    """Session settings of the text operators: few rows per Arrow batch, since
    a row is a whole text that the JVM and its Python worker both hold, and a
    number of input splits that does not follow the executors that happen to
    be there."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def numbered(spark: SparkSession) -> Column:
    """A row's position in a plain table read, the same in every scan."""
    prepared(spark)
    return F.monotonically_increasing_id()


def id_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null id: null)."""
    return F.crc32(doc_id.cast("string")) % F.lit(n)


def held_out(doc_id: Column, n: int, rest: int) -> Column:
    """True for rows set aside; a row without an id is never learned from."""
    return F.coalesce(id_mod(doc_id, n) == rest, F.lit(True))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the row offsets in them (null: empty)."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    if not len(off):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0]:off[-1]] if buf else np.zeros(0, np.uint8)
    return data, off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Arrow batches cut to rows that hold at most ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, off = utf8(batch.column(batch.schema.get_field_index(column)))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
            yield batch.slice(a, b - a), data[off[a]:off[b]], off[a:b + 1] - off[a]
            a = b


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return data + ((data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def space_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: starts, ends, and each row's first word
    (one more entry at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True  # words never cross rows
    prev = np.zeros(n, bool)
    prev[1:] = word[:-1]
    start = np.flatnonzero(word & (~prev | edge[:n]))
    nxt = np.zeros(n, bool)
    nxt[:-1] = word[1:]
    end = np.flatnonzero(word & (~nxt | edge[1:])) + 1
    return start, end, np.searchsorted(start, off)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), so that sums of terms spread."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BASE = 0xA24BAED4963EE407  # odd, hence invertible modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, 2 * len(have) if have is not None else 0), base, np.uint64)
        p[0] = 1
        have = np.cumprod(p, dtype=np.uint64)
        if len(have) <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any byte span."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, equal for equal bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    inv = powers(_INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inv[start] + (end - start).astype(np.uint64))


def with_columns(batch: pa.RecordBatch, keep: list[str], **new) -> pa.RecordBatch:
    """The named columns of ``batch`` beside new arrays."""
    cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
    return pa.RecordBatch.from_arrays(cols + [v if isinstance(v, pa.Array) else pa.array(v) for v in new.values()],
                                      names=keep + list(new))


def released() -> None:
    """Give back what a task's texts needed: a Python worker lives on, and the
    next stage's tasks need the executor's memory for something else."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def dropped(spark: SparkSession, table: DataFrame) -> None:
    """Delete an intermediate table that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for file in table.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(conf).delete(folder, True)
