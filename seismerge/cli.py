"""Command line for the batch and streaming jobs (what the reference runs as
scheduled tasks). Tables live under ``--root``.

  python -m seismerge.cli ingest     --root R --landing L [--limits]   (file stream, available-now)
  python -m seismerge.cli replay     --root R --archive A [--sources AFAD,EMSC,USGS]
  python -m seismerge.cli historical --root R --archive A --start D --end D --run NAME [--min-mag 1.0]
  python -m seismerge.cli harmonize  --root R [--as-of TS] [--max-files N]
  python -m seismerge.cli dedupe     --root R --as-of TS --run NAME [--days 30] [--scan window] [--touched-since TS]
  python -m seismerge.cli sync       --root R [--max-files N] [--out DIR]
  python -m seismerge.cli quality    --root R --as-of TS               (exit code 1 if a check fails)
  python -m seismerge.cli view       --root R --name latest|disagreement|by_province|...
"""

from __future__ import annotations

import argparse
import sys

from .operators import aggregates as A
from .operators.quality import quality_report
from .plans import views as V
from .session import get_spark
from .sources.documents import write_documents
from .streaming import jobs as J

VIEWS = {"latest": V.latest_events, "disagreement": V.disagreement, "drilldown": V.drilldown,
         "by_province": A.by_province, "agreement": A.agreement_histogram, "agreement_terms": A.agreement_terms,
         "province_ranking": A.province_ranking, "magnitude_over_time": A.magnitude_over_time}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="seismerge")
    ap.add_argument("job", choices=["ingest", "replay", "historical", "harmonize", "dedupe", "sync", "quality", "view"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--archive")
    ap.add_argument("--landing")
    ap.add_argument("--limits", action="store_true", help="apply the live magnitude floors, box and response caps")
    ap.add_argument("--sources")
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--run", default="run")
    ap.add_argument("--as-of")
    ap.add_argument("--days", type=int, default=30)
    ap.add_argument("--scan", default="creation_break")
    ap.add_argument("--touched-since")
    ap.add_argument("--max-files", type=int)
    ap.add_argument("--out")
    ap.add_argument("--name", default="latest")
    ap.add_argument("--min-mag", type=float, default=1.0)
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    store = J.Store(a.root)
    if a.job == "ingest":
        J.ingest(J.landed_files(spark, a.landing, a.max_files), store, J.LIVE if a.limits else None).awaitTermination()
    elif a.job == "replay":
        J.replay(spark, J.archived_files(spark, a.archive, a.sources), store)
    elif a.job == "historical":
        ledger = J.historical_load(spark, J.archived_files(spark, a.archive, a.sources), store, a.start, a.end, a.run, a.min_mag)
        ledger.orderBy("source", "chunk_start").show(100, truncate=False)
        return int(not ledger.where("status = 'failed'").isEmpty())
    elif a.job == "harmonize":
        J.harmonize_stream(spark, store, a.as_of, a.max_files).awaitTermination()
    elif a.job == "dedupe":
        f = J.dedupe_days(spark, store, a.run, a.as_of, a.days, a.touched_since, a.scan)
        A.agreement_histogram(f).orderBy("agreement_level").show()
    elif a.job == "sync":
        J.sync_stream(spark, store, a.max_files).awaitTermination()
        if a.out:
            write_documents(store.docs.read(spark).drop("day"), a.out)
    elif a.job == "quality":
        raw = J.raw_view(store.log.read(spark))
        report = quality_report(raw, store.silver.read(spark), store.facts.read(spark), a.as_of)
        report.show(200, truncate=False)
        return int(not report.where("status = 'fail'").isEmpty())
    else:
        VIEWS[a.name](store.facts.read(spark)).show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
