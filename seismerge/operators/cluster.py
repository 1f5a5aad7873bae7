"""Cluster reports of one physical event and build fact rows.

Plan (see README "Clustering at scale"):

1. ``time_sessions`` (C2): reports split wherever the gap to the previous
   report exceeds ``dt_window_s``. With buckets of width ``dt_window_s`` two
   reports in one bucket are always within the window, so a split can only
   fall between buckets: bucket b starts a session iff bucket b-1 is empty or
   ``min(b) - max(b-1) > window``. That needs only a per-bucket aggregate
   (map-side combined, skew-proof), a self equi-join on b-1 and a prefix max
   over the small bucket table (two levels, so the one un-partitioned window
   runs over one row per block of 1024 buckets). No global sort of reports.
2. ``assign_clusters`` (C1, C3-C5, J1): the order-dependent greedy walk runs
   in ``mapInArrow`` over session-partitioned, sorted input: Arrow batches
   in (session, time, priority, source, id) order, keeping only open
   clusters as running sums, so memory is bounded by the open clusters, not
   the session or the partition.
3. ``build_facts`` (C6-C10, P13): native aggregation per (cluster, source) and
   per cluster, both on one hash partitioning by (session, cluster_seq), so
   one shuffle after the fold.
"""

from __future__ import annotations

import math
import sys
from collections import OrderedDict
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.scalar import epoch_us, event_uid, floor_div, iso_utc, source_priority
from ..schemas import DIST_KM_WINDOW, DM_WINDOW, DT_WINDOW_S, EARTH_RADIUS_KM
from ..jvm import map_partitions
from ..session import written
from .space_time import space_time_blocks

# Python workers may not have this package on their path (the session can
# be built by any launcher), so the fold ships by value with its helpers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCAN_MODES = ("creation_break", "window")
BUCKETS_PER_BLOCK = 1024

# Reports per piece of a long block, the time in windows after which reports have
# usually closed the clusters there were, how many such times a piece lasts at least
# (so that few borders depend on more than one piece), the factor that puts a piece's
# members after those of the pieces before it, and a chunk number after all others.
PIECE_REPORTS, WARM_WINDOWS, PIECE_WARM_UPS, PIECE_ORDINALS, NO_CHUNK = 20_000, 6, 4, 1 << 32, 2**31 - 1

# Columns the fold reads, and the member columns it passes through so no
# join back to the reports is needed.
FOLD_INPUT = ["block", "us", "prio", "source", "event_id", "latitude", "longitude", "magnitude"]
PASS_THROUGH = ["session", "event_time", "depth_km", "mag_type", "place", "province", "district"]


def _window_us(dt_window_s: float) -> int:
    return int(round(dt_window_s * 1_000_000))


def time_sessions(reports: DataFrame, dt_window_s: float = DT_WINDOW_S) -> DataFrame:
    """Add ``us`` (event time in epoch microseconds) and ``session`` (the
    90-second bucket number where the report's time session starts)."""
    w_us = _window_us(dt_window_s)
    r = reports.withColumn("us", epoch_us("event_time")) \
        .withColumn("bucket", floor_div(F.col("us"), w_us))
    # One row per non-empty bucket (bounded by time span / window, not by
    # data volume). The steps below repeat this aggregate; their exchanges
    # are equal, so one is run and reused.
    buckets = r.groupBy("bucket").agg(F.min("us").alias("min_us"), F.max("us").alias("max_us"))
    prev = buckets.select((F.col("bucket") + 1).alias("bucket"), F.col("max_us").alias("prev_max"))
    starts = (buckets.join(prev, "bucket", "left")
              .select("bucket",
                      (F.col("prev_max").isNull() | (F.col("min_us") - F.col("prev_max") > w_us))
                      .alias("is_start"))
              .withColumn("block", floor_div(F.col("bucket"), BUCKETS_PER_BLOCK)))
    in_block = Window.partitionBy("block").orderBy("bucket") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = starts.withColumn("start_in_block",
                               F.max(F.when(F.col("is_start"), F.col("bucket"))).over(in_block))
    # One row per block: the last session start inside it; the prefix max over
    # earlier blocks carries a session across block borders.
    blocks = starts.groupBy("block").agg(F.max("start_in_block").alias("last_start"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select("block", F.max("last_start").over(earlier).alias("carry"))
    # A table of its own: its size is then known before the reports are read, and
    # they are not shuffled to meet a small one.
    sessions = written(reports.sparkSession, starts.join(carry, "block").select(
        "bucket", F.coalesce("start_in_block", "carry").alias("session")), "session-starts")
    return r.join(sessions, "bucket").drop("bucket")


def _half_sine_sq(degrees: float) -> float:
    half = math.sin(math.radians(degrees) * 0.5)
    return half * half


def _surface_km(here: tuple[float, float], there: tuple[float, float]) -> float:
    """Distance of two (latitude, longitude) points, as ``haversine_km`` has it."""
    parallels = math.cos(math.radians(here[0])) * math.cos(math.radians(there[0]))
    h = _half_sine_sq(there[0] - here[0]) + parallels * _half_sine_sq(there[1] - here[1])
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(min(h, 1.0)))


class _Walk:
    """The open clusters of one block, as running sums, in cells of space.

    A cluster stands in the cell of its centroid: a cube beside the unit sphere,
    as wide as the chord of the distance limit, so that what a report may join
    is in its own cube or one next to it, also at a pole or the antimeridian.
    A report's cost follows the clusters around it, not all open ones. Of these,
    the chord to the centroid tells which are near, but for those so close to
    the limit that rounding might count: their distance is computed."""

    def __init__(self, w_us: int, dist_km: float, dm: float, break_mode: bool):
        self.w_us, self.dist_km, self.dm, self.break_mode = w_us, dist_km, dm, break_mode
        self.side = 2 * math.sin(min(dist_km / (2 * EARTH_RADIUS_KM), math.pi / 2)) * (1 + 1e-6) + 1e-9
        across = 2 * math.ceil(1 / self.side) + 5
        self.around = [(x * across + y) * across + z for x in (-1, 0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1)]
        self.across, self.made, self.cut = across, 0, -1
        chord_sq = 4 * _half_sine_sq(math.degrees(min(dist_km / EARTH_RADIUS_KM, math.pi)))
        # Of very short chords too few digits are left.
        self.surely, self.maybe = (chord_sq * (1 - 1e-6), chord_sq * (1 + 1e-6)) if chord_sq > 1e-12 else (-1.0, math.inf)
        self.newest: list | None = None
        # Cluster: [id, newest us, lat sum, lon sum, n, magnitude sum, magnitudes, age, cell, x, y, z].
        self.recent: OrderedDict[int, list] = OrderedDict()  # by age, the one with the oldest newest member first
        self.cells: dict[int, dict[int, list]] = {}

    @property
    def open(self) -> list[list]:
        """[id, newest us, lat sum, lon sum, n, magnitude sum, magnitudes], newest cluster last."""
        return [c[:7] for _, c in sorted(self.recent.items()) if c[7] > self.cut]

    @open.setter
    def open(self, clusters: list[list]) -> None:
        self.recent, self.cells, self.made, self.cut = OrderedDict(), {}, len(clusters), -1
        for age, c in sorted(enumerate(clusters), key=lambda x: x[1][1]):
            self.put([*c, age, None, 0.0, 0.0, 0.0])

    def spot(self, lat: float, lon: float) -> tuple[int | None, float, float, float]:
        """A point's cube, and the point on the unit sphere; no cube for one
        that is near to nothing (not a number)."""
        if lat != lat or lon != lon:
            return None, 0.0, 0.0, 0.0
        a, b, side, across = math.radians(lat), math.radians(lon), self.side, self.across
        flat = math.cos(a)
        x, y, z = flat * math.cos(b), flat * math.sin(b), math.sin(a)
        return (math.floor(x / side) * across + math.floor(y / side)) * across + math.floor(z / side), x, y, z

    def put(self, c: list) -> None:
        """Into its cell, as the one with the newest member."""
        cell, c[9], c[10], c[11] = self.spot(c[2] / c[4], c[3] / c[4])
        if cell != c[8]:
            if c[8] is not None:
                self.leave(c)
            c[8] = cell
            if cell is not None:
                self.cells.setdefault(cell, {})[c[7]] = c
        self.recent[c[7]] = c
        self.recent.move_to_end(c[7])

    def leave(self, c: list) -> None:
        there = self.cells[c[8]]
        del there[c[7]]
        if not there:
            del self.cells[c[8]]

    def place(self, t: int, lat: float, lon: float, mag: float | None, new_id: int | None) -> int | None:
        """The cluster the report joins; ``new_id`` if it opens its own, which
        is then ``newest``.

        Of the open clusters that fit, the one with the smallest time gap wins,
        the newest-created on ties. With ``break_mode`` the search goes from
        the newest-created cluster to the first whose newest member is more
        than the window older; all clusters behind it are out of reach for
        good."""
        self.prune(t)
        best, best_dt, cut, dm, surely, maybe, passed = None, 0, self.cut, self.dm, self.surely, self.maybe, None
        cell, x, y, z = self.spot(lat, lon)
        if cell is not None:
            get = self.cells.get
            for step in self.around:
                there = get(cell + step)
                if there:
                    for c in there.values():
                        if c[7] <= cut:
                            passed = [c] if passed is None else [*passed, c]
                            continue
                        dt = t - c[1]
                        if best is not None and (dt > best_dt or (dt == best_dt and c[7] < best[7])):
                            continue
                        if mag is not None and c[6] and abs(mag - c[5] / c[6]) > dm:
                            continue
                        chord_sq = (x - c[9]) ** 2 + (y - c[10]) ** 2 + (z - c[11]) ** 2
                        if chord_sq <= surely or (chord_sq <= maybe and _surface_km(
                                (lat, lon), (c[2] / c[4], c[3] / c[4])) <= self.dist_km):
                            best, best_dt = c, dt
        for c in passed or ():
            del self.recent[c[7]]
            self.leave(c)
        if best is None:
            self.newest = [new_id, t, lat, lon, 1, 0.0 if mag is None else mag, 0 if mag is None else 1, self.made, None, 0.0, 0.0, 0.0]
            self.put(self.newest)
            self.made += 1
            return new_id
        best[1] = max(best[1], t)
        best[2] += lat
        best[3] += lon
        best[4] += 1
        if mag is not None:
            best[5] += mag
            best[6] += 1
        self.put(best)
        return best[0]

    def prune(self, t: int) -> None:
        """Drop what no report at ``t`` or later can reach."""
        while self.recent:
            age, c = next(iter(self.recent.items()))
            if t - c[1] <= self.w_us:
                return
            del self.recent[age]
            if c[8] is not None:
                self.leave(c)
            if self.break_mode:
                self.cut = max(self.cut, age)


def _check_scan(scan: str) -> bool:
    if scan not in SCAN_MODES:
        raise ValueError(f"scan must be one of {SCAN_MODES}")
    return scan == "creation_break"


def _values(batch: pa.RecordBatch, *names: str) -> list[list]:
    """Columns of a batch as lists of numbers; a null among floats is not a number."""
    return [batch.column(n).to_numpy(zero_copy_only=False).tolist() for n in names]


def _with_columns(batch: pa.RecordBatch, **more: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *more.values()], names=[*batch.schema.names, *more])


def make_fold(dt_window_s: float = DT_WINDOW_S, dist_km: float = DIST_KM_WINDOW,
              dm: float = DM_WINDOW, scan: str = "creation_break"):
    """The per-block greedy walk (C1 with J1 as the match rule).

    Reports arrive in (time, priority, source, event_id) order.
    ``creation_break`` ends a search at the first cluster whose newest member
    is more than the window older (the reference behaviour, B3); ``window``
    tests every cluster whose newest member is within the window.
    """
    break_mode, w_us = _check_scan(scan), _window_us(dt_window_s)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One partition: blocks one after another, each in walk order.
        block, walk, clusters, ordinal = None, None, 0, 0
        for batch in batches:
            seqs, ords = [], []
            for b, t, lat, lon, mag in zip(*_values(batch, "block", "us", "latitude", "longitude", "magnitude")):
                if b != block:
                    block, walk, clusters, ordinal = b, _Walk(w_us, dist_km, dm, break_mode), 0, 0
                if mag != mag:  # not a number stands for null
                    mag = None
                seq = walk.place(t, lat, lon, mag, clusters)
                clusters += seq == clusters
                seqs.append(seq)
                ords.append(ordinal)
                ordinal += 1
            yield _with_columns(batch, cluster_seq=pa.array(seqs, pa.int64()), member_ord=pa.array(ords, pa.int64()))
    return fold


#: Columns that a long block's walk reads, in the order of the walk; all of them,
#: so that reports which the order does not tell apart are the same to it.
WALK_ORDER = ["us", "prio", "source", "event_id", "latitude", "longitude", "magnitude"]
PACKED = ["us", "latitude", "longitude", "magnitude"]
PACK_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in ("block", "piece")] + [T.StructField("chunk", T.IntegerType())]
                           + [T.StructField(c, T.BinaryType()) for c in PACKED])
BORDER_SCHEMA = T.StructType([*PACK_SCHEMA.fields[:3], T.StructField("state", T.BinaryType())])
HEAD = ["next_us", "changed", "state"]
HEAD_SCHEMA = T.StructType([*PACK_SCHEMA.fields[:3], T.StructField("next_us", T.LongType()), T.StructField("changed", T.BooleanType()),
                            T.StructField("state", T.BinaryType()), *PACK_SCHEMA.fields[3:]])
ID_SCHEMA = T.StructType([*PACK_SCHEMA.fields[:3], T.StructField("ids", T.BinaryType())])
BORDERS, CHAIN, CLUSTERS = range(3)  # what PieceWalk.java gives


def _runs(batch: pa.RecordBatch, *keys: str) -> Iterator[tuple[int, int]]:
    """Where rows of equal keys, which are not null, begin and end."""
    if batch.num_rows:
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in keys]
        new = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        yield from zip([0, *(np.flatnonzero(new) + 1).tolist()], [*(np.flatnonzero(new) + 1).tolist(), batch.num_rows])


def pack_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports in order of (block, piece, walk) as rows of packed numbers; a null is not a number."""
    at, chunk, schema = None, 0, PACK_ARROW
    for batch in batches:
        rows = []
        for lo, hi in _runs(batch, "block", "piece"):
            here = batch.column("block")[lo].as_py(), batch.column("piece")[lo].as_py()
            at, chunk = (at, chunk + 1) if here == at else (here, 0)
            numbers = [batch.column(c).slice(lo, hi - lo).to_numpy(zero_copy_only=False) for c in PACKED]
            rows.append((*here, chunk, *[n.astype("<i8" if c == "us" else "<f8").tobytes() for c, n in zip(PACKED, numbers)]))
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)] if rows else
                                         [pa.array([], f.type) for f in schema], schema=schema)


PACK_ARROW = pa.schema([("block", pa.int64()), ("piece", pa.int64()), ("chunk", pa.int32()), *[(c, pa.binary()) for c in PACKED]])


def attach_clusters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces, each as its rows of cluster numbers (``ids``) and then its reports
    in walk order: the reports with ``cluster_seq`` and ``member_ord``."""
    at, ids, given, ordinal = None, None, [], 0
    for batch in batches:
        keep, seqs, ords = [], [], []
        for lo, hi in _runs(batch, "block", "piece", "chunk"):
            here = batch.column("block")[lo].as_py(), batch.column("piece")[lo].as_py()
            if here != at:
                at, ids, given, ordinal = here, None, [], 0
            if batch.column("chunk")[lo].as_py() < NO_CHUNK:
                given += [np.frombuffer(x, "<i8") for x in batch.column("ids").slice(lo, hi - lo).to_pylist()]
                continue
            if ids is None:
                ids, given = np.concatenate(given), []
            keep.append(batch.slice(lo, hi - lo))
            seqs.append(ids[ordinal:ordinal + hi - lo])
            ords.append(np.arange(ordinal, ordinal + hi - lo) + here[1] * PIECE_ORDINALS)
            ordinal += hi - lo
        names = [c for c in batch.schema.names if c not in ("piece", "chunk", "ids")]
        if keep:
            rows = pa.Table.from_batches(keep).select(names).combine_chunks().to_batches()[0]
            yield _with_columns(rows, cluster_seq=pa.array(np.concatenate(seqs)), member_ord=pa.array(np.concatenate(ords)))


def piece_table(reports: DataFrame, w_us: int, piece_reports: int, windows: int = 0) -> DataFrame:
    """(block, bucket, piece): blocks cut at bucket borders into pieces of
    about ``piece_reports``, or more where so many take less time than
    ``windows`` buckets. Its size follows the time span, not the reports."""
    per = reports.groupBy("block", floor_div(F.col("us"), w_us).alias("bucket")).agg(
        F.count("*").alias("n"), F.min("us").alias("first_us"))
    so_far = Window.partitionBy("block").orderBy("bucket")
    ahead = so_far.rowsBetween(Window.unboundedPreceding, -1)
    at = F.floor(F.coalesce(F.sum("n").over(ahead), F.lit(0)) / piece_reports)
    if windows:
        at = F.least(at, F.floor((F.col("bucket") - F.min("bucket").over(so_far)) / windows))
    reached = per.withColumn("at", at)
    # Numbered without gaps, also where one bucket holds more than a piece.
    in_order = Window.partitionBy("block").orderBy("at")
    return reached.withColumn("piece", F.dense_rank().over(in_order).cast("long") - 1).drop("at")


def _walk_in_pieces(r: DataFrame, cols: list[str], piece_of: DataFrame, dt_window_s: float, dist_km: float,
                    dm: float, scan: str) -> DataFrame:
    """A long block in pieces, exact by check.

    What a piece does depends on the clusters that are open where it begins, and
    where reports never let a cluster close, on all pieces before it. What is
    sought are these borders; they are found on packed numbers alone
    (``PieceWalk.java``), some 30 bytes a report. First every piece is walked from
    nothing, by its own task, and then from the clusters that its predecessor
    ended with. Where that changes no border, all are right, by induction from the
    first piece. Otherwise one task a block goes through the pieces whose
    predecessor ended otherwise than they were given, and through those after
    them until the borders agree again. With the borders known, every piece's
    reports are given their clusters, by its own task."""
    spark, at, break_mode = r.sparkSession, ["block", "piece"], _check_scan(scan)
    starts = piece_of.groupBy(*at).agg(F.min("first_us").alias("start_us"))
    nxt = starts.select("block", (F.col("piece") - 1).alias("piece"), F.col("start_us").alias("next_us"))
    pieces = written(spark, starts.select(*at).join(nxt, at, "left"), "pieces")
    own = r.select(*cols).withColumn("bucket", floor_div(F.col("us"), _window_us(dt_window_s))).join(
        piece_of.select("block", "bucket", "piece"), ["block", "bucket"]).drop("bucket")
    packed = own.select(*at, *WALK_ORDER).repartition(*at).sortWithinPartitions(*at, *WALK_ORDER)
    packs = written(spark, packed.mapInArrow(pack_pieces, PACK_SCHEMA), "packs")

    def walk(mode: int, heads: DataFrame, rows: DataFrame, schema: T.StructType, by: list[str]) -> DataFrame:
        blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in HEAD_SCHEMA}
        both = [d.select(*[F.col(c) if c in d.columns else blank[c] for c in HEAD_SCHEMA.names])
                for d in (heads.withColumn("chunk", F.lit(-1)), rows)]
        ordered = both[0].unionByName(both[1]).repartition(*by).sortWithinPartitions("block", "piece", "chunk")
        return map_partitions(ordered, "PieceWalk", schema, mode, _window_us(dt_window_s), float(dist_km), float(dm), EARTH_RADIUS_KM, break_mode)

    def after(states: DataFrame) -> DataFrame:
        """Pieces with the state that the piece before them ended with."""
        return pieces.join(states.select("block", (F.col("piece") + 1).alias("piece"), "state"), at, "left")
    alone = written(spark, walk(BORDERS, pieces, packs, BORDER_SCHEMA, at), "borders")
    states = written(spark, walk(BORDERS, after(alone), packs, BORDER_SCHEMA, at), "borders")
    changed = states.join(alone.select(*at, F.col("state").alias("was")), at).select(*at, "state", (F.col("state") != F.col("was")).alias("changed"))
    changed = written(spark, changed, "changed")
    first = changed.where("changed").groupBy("block").agg(F.min("piece").alias("first"))
    if not first.isEmpty():
        heads = pieces.join(changed, at).join(first, "block").where("piece >= first").drop("first")
        late = packs.join(first, "block").where("piece > first").drop("first")
        mended = written(spark, walk(CHAIN, heads, late, BORDER_SCHEMA, ["block"]), "mended")
        states = states.join(mended, at, "left_anti").unionByName(mended)
    ids = walk(CLUSTERS, after(states), packs, ID_SCHEMA, at)
    reports = own.select(*cols, "piece", F.lit(NO_CHUNK).alias("chunk"), F.lit(None).cast("binary").alias("ids"))
    # A number is 0 in a row of ids, as a column with a null one would be read as floats.
    blank = {c: F.lit(0 if isinstance(r.schema[c].dataType, T.IntegralType) else None).cast(r.schema[c].dataType).alias(c) for c in cols}
    both = reports.unionByName(ids.select(*[F.col(c) if c in ids.columns else blank[c] for c in reports.columns]))
    schema = T.StructType([r.schema[c] for c in cols] + [T.StructField(c, T.LongType()) for c in ("cluster_seq", "member_ord")])
    ordered = both.repartition(*at).sortWithinPartitions(*at, "chunk", *WALK_ORDER)
    return written(spark, ordered.mapInArrow(attach_clusters, schema), "walked")


def assign_clusters(sessions: DataFrame, dt_window_s: float = DT_WINDOW_S,
                    dist_km: float = DIST_KM_WINDOW, dm: float = DM_WINDOW,
                    scan: str = "creation_break", num_partitions: int | None = None,
                    spatial_split: bool = True, piece_reports: int | None = PIECE_REPORTS,
                    warm_windows: int = WARM_WINDOWS, stored: bool = False, table: bool = False) -> DataFrame:
    """Run the fold. Input: ``time_sessions`` output. Output: one row per
    report with ``block``, ``prio``, ``cluster_seq`` (creation order inside
    the block) and ``member_ord`` (walk order inside the block).

    Blocks are sessions, or for ``scan="window"`` the components of reports
    near in time and space (``space_time_blocks``). They are hash-partitioned
    and each partition is sorted by (block, walk order); ``mapInArrow`` then
    streams the partition through the fold in Arrow batches, resetting at each
    block boundary. No per-group frame is built, so many small blocks
    cost nothing extra and one huge block needs only its open clusters in
    memory. A block of more than ``piece_reports`` reports is walked in pieces
    by several tasks, with the same result (``_walk_in_pieces``), which stands in
    a written table then; with ``stored`` it does so in any case. With ``table``
    the input is a written table, which need not be written again.
    """
    spark, w_us = sessions.sparkSession, _window_us(dt_window_s)
    r = sessions.withColumn("prio", source_priority("source"))
    cols = FOLD_INPUT + [c for c in PASS_THROUGH if c in r.columns]
    r = r.select(*[c for c in cols if c != "block"])
    # Once, as a table: the steps below read it more than once.
    if scan == "window" and spatial_split:
        r = written(spark, space_time_blocks(r, w_us, 2 * dist_km + 10.0), "blocked")
    else:
        r = (r if table else written(spark, r, "sessions")).withColumn("block", F.col("session"))
    if piece_reports and not r.groupBy("block").count().where(F.col("count") > piece_reports).isEmpty():
        piece_of = written(spark, piece_table(r, w_us, piece_reports, PIECE_WARM_UPS * warm_windows), "piece-buckets")
        return _walk_in_pieces(r, cols, piece_of, dt_window_s, dist_km, dm, scan)
    part = [num_partitions] if num_partitions else []
    ordered = (r.select(*cols)
               .repartition(*part, "block")
               .sortWithinPartitions("block", "us", "prio", "source", "event_id"))
    schema = T.StructType([ordered.schema[c] for c in cols] + [
        T.StructField("cluster_seq", T.LongType()), T.StructField("member_ord", T.LongType())])
    walked = ordered.mapInArrow(make_fold(dt_window_s, dist_km, dm, scan), schema)
    return written(spark, walked, "walked") if stored else walked


def build_facts(assigned: DataFrame, as_of=None, dt_window_s: float = DT_WINDOW_S) -> DataFrame:
    """C3-C10 + P13: one fact row per cluster (FACT schema + ``creation``).

    ``creation`` is the walk key of the cluster's first member (session,
    time, priority, source, id): the order clusters were created, in either
    scan mode. ``cluster_key`` = (block, cluster_seq) joins back to members.
    """
    member = F.struct("event_id", "event_time", "latitude", "longitude", "depth_km", "magnitude",
                      "mag_type", "place", "province", "district", "us", "member_ord", "prio")
    sv = F.struct(F.col("event_id"), F.col("magnitude"), F.col("mag_type"), F.col("depth_km"),
                  iso_utc("event_time").alias("event_time"), F.col("latitude"),
                  F.col("longitude"), F.col("place"))
    walk_key = F.struct("session", "us", "prio", "source", "event_id")
    # By cluster before the members are aggregated: both aggregations then run
    # where the rows are, and what is shuffled are the reports, once.
    per_source = assigned.repartition("block", "cluster_seq").groupBy("block", "cluster_seq", "source").agg(
        F.min("event_time").alias("t_min"),
        F.min(walk_key).alias("first_key"),
        F.min_by(member, F.struct("us", "member_ord")).alias("first"),
        F.max_by(sv, F.col("member_ord")).alias("sv"),
    )
    updated = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    pref_key = F.struct(F.col("first.prio"), F.col("first.us"), F.col("first.member_ord"))
    cl = per_source.groupBy("block", "cluster_seq").agg(
        F.min("t_min").alias("t_min"),
        F.min("first_key").alias("creation"),
        F.min_by(F.struct(F.col("source"), F.col("first").alias("m")), pref_key).alias("pref"),
        F.array_sort(F.collect_list("source")).alias("sources"),
        F.map_from_entries(F.collect_list(F.struct("source", "sv"))).alias("source_values"),
    )
    p = F.col("pref.m")
    facts = cl.select(
        event_uid(F.col("t_min"), p["latitude"], p["longitude"], dt_window_s).alias("event_uid"),
        F.col("t_min").alias("event_time"),
        p["latitude"].alias("latitude"), p["longitude"].alias("longitude"),
        p["depth_km"].alias("depth_km"), p["magnitude"].alias("magnitude"),
        p["mag_type"].alias("mag_type"), p["place"].alias("place"),
        p["province"].alias("province"), p["district"].alias("district"),
        F.col("pref.source").alias("preferred_source"),
        F.size("sources").cast("short").alias("agreement_level"),
        F.col("sources"), F.col("source_values"),
        F.col("t_min").alias("first_seen_at"),
        updated.alias("updated_at"),
        F.col("creation"),
        F.struct("block", "cluster_seq").alias("cluster_key"),
    )
    return facts


def unique_uid(facts: DataFrame) -> DataFrame:
    """Two clusters of one run may share a uid; the later-created wins."""
    cols = [c for c in facts.columns if c != "event_uid"]
    return (facts.groupBy("event_uid")
            .agg(F.max_by(F.struct(*cols), F.col("creation")).alias("f"))
            .select("event_uid", "f.*"))


def dedupe(reports: DataFrame, as_of=None, dt_window_s: float = DT_WINDOW_S,
           dist_km: float = DIST_KM_WINDOW, dm: float = DM_WINDOW,
           scan: str = "creation_break") -> DataFrame:
    """C1-C10 end to end: canonical reports -> fact rows with unique uid."""
    s = time_sessions(reports.where(F.col("event_time").isNotNull()), dt_window_s)
    a = assign_clusters(s, dt_window_s, dist_km, dm, scan)
    return unique_uid(build_facts(a, as_of, dt_window_s))


def cluster_members(assigned: DataFrame) -> DataFrame:
    """Per report: the cluster's first member as ``source:event_id`` (a
    numbering-free cluster key) and the cluster size."""
    key = F.concat_ws(":", "source", "event_id")
    heads = assigned.groupBy("block", "cluster_seq").agg(
        F.min_by(key, F.col("member_ord")).alias("cluster_head"),
        F.count("*").alias("cluster_size"))
    return assigned.join(heads, ["block", "cluster_seq"])
