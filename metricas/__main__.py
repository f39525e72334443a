"""Command line: run the jobs on a cluster (spark-submit) or locally.

  python -m metricas ingest  --landing DIR --tables DIR [--platform P ...] [--as-of DATE] [--format json|parquet]
  python -m metricas stream  --landing DIR --tables DIR [--format json|parquet] [--unreadable SHARE]
  python -m metricas recompute-deltas --tables DIR [--full]
  python -m metricas compact --tables DIR [--keep N]

``ingest`` runs the platform jobs over all runs of a landed folder, in order, and
merges into the tables (``--as-of`` dates runs without a date); ``stream`` processes
the complete runs not processed before (``--unreadable``: the share of a run's pages that may be no JSON, 0 if not
given); ``recompute-deltas`` recomputes the daily table's deltas (first row NULL) of the posts with new rows, or of
all; ``compact`` merges small file sets and deletes those that the last N states of the tables don't name.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from metricas.plans import landed
from metricas.session import apply_cluster_conf, ensure_checkpoint_dir
from metricas.sources import warehouse as W
from metricas.sources.landing import read_landed, runs
from metricas.streaming import process_runs, run_available


def _date(text: str | None) -> dt.date:
    return dt.date.fromisoformat(text) if text else dt.datetime.now(dt.timezone.utc).date()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="metricas")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--tables", required=True)
    ing.add_argument("--platform", action="append", choices=sorted(landed.PLATFORMS))
    ing.add_argument("--as-of")
    ing.add_argument("--format", default="json", choices=["json", "parquet"])
    st = sub.add_parser("stream")
    st.add_argument("--landing", required=True)
    st.add_argument("--tables", required=True)
    st.add_argument("--format", default="json", choices=["json", "parquet"])
    for p in (ing, st):
        p.add_argument("--unreadable", type=float, default=0.0)
    rc = sub.add_parser("recompute-deltas")
    rc.add_argument("--tables", required=True)
    rc.add_argument("--full", action="store_true")
    cp = sub.add_parser("compact")
    cp.add_argument("--tables", required=True)
    cp.add_argument("--keep", type=int, default=2)
    args = ap.parse_args(argv)

    spark = apply_cluster_conf(SparkSession.builder.appName(f"metricas-{args.cmd}").getOrCreate())
    ensure_checkpoint_dir(spark)
    if args.cmd == "ingest":
        pages = read_landed(spark, args.landing, fmt=args.format)
        process_runs(spark, pages, args.tables, runs(pages), _date(args.as_of), args.platform,
                     args.unreadable)
    elif args.cmd == "stream":
        run_available(spark, args.landing, args.tables, fmt=args.format, unreadable=args.unreadable)
    elif args.cmd == "compact":
        W.compact(spark, args.tables)
        W.vacuum(spark, args.tables, args.keep)
    else:
        W.recompute_deltas(spark, args.tables, args.full)


if __name__ == "__main__":
    main()
