"""Blocks of reports that cannot meet in a window-mode walk.

In window mode a report only joins a cluster whose newest member is within the
time window, and lies within ``link_km`` of that member (both are near the
centroid). With buckets as wide as the window, reports can only meet if their
(bucket, cell) nodes are neighbours: cells next to each other, buckets equal or
consecutive. The connected components of the occupied nodes are therefore
walked independently, also within one long session.

Components are found in two steps. ``CHUNK`` buckets of time at a time, nodes
are united by their neighbours in one pass; a chunk also sees the first bucket
of the next one. A node seen by two chunks has two labels, which are an edge;
components over these edges (star steps) unite the chunks' labels. Only nodes
in every ``CHUNK``-th bucket make edges, so the joined graph is small.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import floor_div
from ..schemas import EARTH_RADIUS_KM
from ..session import written
from .components import connected_components

# The package need not be on the workers' path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Buckets of a chunk, and the factors that make one number of (bucket, band, column).
CHUNK, BANDS, COLUMNS = 64, 256, 4096


def band_width(i: int, h: float) -> float:
    """Longitude width (degrees) of the cells of latitude band ``i``, widened by
    1/cos of its highest latitude, so that next cells reach ``h`` degrees."""
    edge = max(abs(i * h - 90.0), abs((i + 1) * h - 90.0))
    return h / math.cos(math.radians(min(88.0, edge + h)))


def band_width_col(i: Column, h: float) -> Column:
    edge = F.greatest(F.abs(i * F.lit(h) - 90.0), F.abs((i + 1) * F.lit(h) - 90.0))
    return F.lit(h) / F.cos(F.radians(F.least(F.lit(88.0), edge + h)))


def neighbours(i: int, j: int, h: float) -> Iterator[tuple[int, int]]:
    """Cells of bands i-1 to i+1 whose longitudes overlap the cell's, padded by
    one cell; longitude wraps."""
    w = band_width(i, h)
    for other in (i - 1, i, i + 1):
        if other >= 0:
            w2 = band_width(other, h)
            around = math.ceil(360.0 / w2)
            for j2 in range(math.floor(j * w / w2) - 1, math.floor((j + 1) * w / w2) + 2):
                yield other, j2 % around


class _Chunk:
    """Union-find over the nodes of one chunk, bucket by bucket."""

    def __init__(self, h: float):
        self.h, self.rows, self.parent = h, [], []
        self.bucket, self.hub, self.here, self.before, self.last_hub = None, False, {}, {}, False

    def find(self, a: int) -> int:
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def unite(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)

    def add(self, bucket: int, i: int, j: int, hub: bool) -> None:
        if bucket != self.bucket:
            self.close()
            if bucket - 1 != self.bucket:
                self.before, self.last_hub = {}, False
            self.bucket, self.hub = bucket, hub
        self.here[i, j] = len(self.rows)
        self.rows.append((bucket, i, j))
        self.parent.append(len(self.parent))

    def close(self) -> None:
        """Links of the bucket that ends here, to itself and the one before."""
        nodes = list(self.here.values())
        if self.hub:
            for k in nodes + (list(self.before.values()) if self.last_hub else []):
                self.unite(nodes[0], k)
        for (i, j), k in self.here.items():
            for cell in neighbours(i, j, self.h):
                for group in (self.here, self.before):
                    if cell in group:
                        self.unite(k, group[cell])
        self.before, self.last_hub, self.here, self.hub = self.here, self.hub, {}, False

    def labels(self) -> list[int]:
        """Per node, its component's first node as a number."""
        self.close()
        return [(b * BANDS + i) * COLUMNS + j for b, i, j in (self.rows[self.find(k)] for k in range(len(self.rows)))]


def label_chunks(h: float):
    """mapInPandas body over nodes sorted by (chunk, bucket, i, j)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done() -> pd.DataFrame:
            out = pd.DataFrame(nodes.rows, columns=["bucket", "i", "j"])
            return out.assign(chunk=chunk, label=nodes.labels())[["chunk", "bucket", "i", "j", "label"]]
        chunk, nodes = None, None
        for pdf in batches:
            for c, bucket, i, j, hub in zip(*[pdf[x].tolist() for x in ("chunk", "bucket", "i", "j", "hub")]):
                if c != chunk:
                    if nodes:
                        yield done()
                    chunk, nodes = c, _Chunk(h)
                nodes.add(bucket, i, j, hub)
        if nodes:
            yield done()
    return run


def space_time_blocks(reports: DataFrame, w_us: int, link_km: float) -> DataFrame:
    """``reports`` (with ``us``, latitude, longitude; read twice) with
    ``block``: the first node of its component, as a number.

    Within ``link_km`` of the antimeridian a mean longitude can be anywhere,
    and near a pole (by ten times ``link_km``) longitudes differ widely over
    short distances. A cluster only steps over a long way next to such a
    report, so all nodes of the buckets around it are united.
    """
    spark = reports.sparkSession
    h = max(1.0, link_km / 111.0)
    degree_km = math.pi * EARTH_RADIUS_KM / 180
    to_pole = (90.0 - F.abs(F.col("latitude"))) * degree_km
    to_edge = (180.0 - F.abs(F.col("longitude"))) * degree_km * F.cos(F.radians("latitude"))
    placed = (reports.withColumn("bucket", floor_div(F.col("us"), w_us))
              .withColumn("i", F.floor((F.col("latitude") + 90.0) / h).cast("int"))
              .withColumn("j", F.floor((F.col("longitude") + 180.0) / band_width_col(F.col("i"), h)).cast("int")))
    key = ["bucket", "i", "j"]
    nodes = written(spark, placed.groupBy(*key).agg(
        F.max((to_pole < 10 * link_km) | (to_edge < 1.1 * link_km)).alias("odd")), "nodes")
    hubs = nodes.where("odd").select(F.explode(F.sequence(F.col("bucket") - 1, F.col("bucket") + 1)).alias("bucket")).distinct()
    hubs = written(spark, hubs.withColumn("hub", F.lit(True)), "hubs")
    own = floor_div(F.col("bucket"), CHUNK)
    chunks = F.when(F.pmod("bucket", F.lit(CHUNK)) == 0, F.array(own, own - 1)).otherwise(F.array(own))
    seen = (nodes.join(hubs, "bucket", "left").select(F.explode(chunks).alias("chunk"), *key, F.coalesce("hub", F.lit(False)).alias("hub"))
            .repartition("chunk").sortWithinPartitions("chunk", *key))
    labels = written(spark, seen.mapInPandas(label_chunks(h), "chunk long, bucket long, i int, j int, label long"), "node-labels")
    twice = labels.where(F.pmod("bucket", F.lit(CHUNK)) == 0).groupBy(*key).agg(F.min("label").alias("a"), F.max("label").alias("b"))
    united = written(spark, connected_components(spark, twice.where("a <> b").select("a", "b")), "blocks")
    one = labels.where(F.col("chunk") == own).join(united, F.col("label") == F.col("node"), "left")
    one = written(spark, one.select(*key, F.coalesce("component", "label").alias("block")), "node-blocks")
    return placed.join(one, key).drop(*key)
