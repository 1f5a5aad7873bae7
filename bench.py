"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
First the layer jobs run from the driver's tables (archive of agency
responses rendered from ``events`` -> raw -> harmonized -> clustered
members -> facts, each written as a table), then
the headline queries read those layers. Every step is timed and counted in
the total; queries run fully via the ``noop`` sink (nothing is collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seismerge.plans import queries as Q  # noqa: E402
from seismerge.plans.queries import REGISTRY  # noqa: E402
from seismerge.session import get_spark  # noqa: E402

# Layer builds (the batch jobs), then the queries that read the layers.
LAYERS = [("build_archive", Q._archive), ("build_bronze", Q._bronze),
          ("build_silver", Q._silver), ("build_clusters", Q._assigned),
          ("build_facts", Q._facts)]
HEADLINE = ["harmonize", "time_sessions", "clusters", "fact_earthquakes", "by_province",
            "latest_events", "magnitude_over_time", "upsert_mart", "upsert_raw_fill",
            "quality_report"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    times = {}
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    for name, build in LAYERS:
        t0 = time.time()
        build(spark, sf_dir)
        times[name] = round(time.time() - t0, 3)
    for name in names:
        fn = REGISTRY[name][0]
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    n_reports = Q._silver(spark, sf_dir).count()
    n_facts = Q._facts(spark, sf_dir).count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(times.values()), 3)
    pipeline = sum(times[k] for k, _ in LAYERS if k != "build_archive")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "events": n_events, "reports": n_reports, "facts": n_facts,
                      "pipeline_reports_per_sec": round(n_reports / pipeline) if pipeline else None,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
