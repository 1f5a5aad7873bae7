"""seismerge: a PySpark engine that merges overlapping earthquake feeds.

Layers (all DataFrame jobs):

* ``sources``   -- archive scan, per-agency payload parsing, document sink,
                   and the adapter that derives agency feeds from the driver tables.
* ``functions`` -- Column-level helpers (time parsing, haversine, uid, ...).
* ``operators`` -- canonical mapping, clustering, upserts, aggregates, quality.
* ``plans``     -- the serving views and the end-to-end batch jobs.
* ``streaming`` -- Structured Streaming ingestion and incremental jobs.
"""

from .session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
