"""Command-line entry for a run (``spark-submit riskmart/plans/cli.py ...`` or
``python -m riskmart.plans.cli ...``).

Either give one ``--root`` (landing/, bronze/, silver/, gold/ below it) or the
individual locations.  Without ``--ingestion-date`` every landed day is run;
``--backfill-from/--backfill-to`` run a day range with the newest reference.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from riskmart.plans.arrival import run_arrived
from riskmart.plans.runs import RunConfig, backfill, run
from riskmart.sinks.register import MODES


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="riskmart", description="Bronze -> Silver -> Gold risk mart run")
    p.add_argument("--root", help="base folder holding landing/, bronze/, silver/, gold/")
    p.add_argument("--landing-events")
    p.add_argument("--landing-reference")
    p.add_argument("--bronze-events")
    p.add_argument("--bronze-reference")
    p.add_argument("--silver")
    p.add_argument("--gold")
    p.add_argument("--ingestion-date", action="append", dest="ingestion_dates",
                   help="YYYY-MM-DD; repeat for several days (default: every landed day)")
    p.add_argument("--events-file", help="run one delivered events file (its day: --ingestion-date or its folder)")
    p.add_argument("--reference-file", help="a chosen reference file (default: the newest delivery)")
    p.add_argument("--backfill-from")
    p.add_argument("--backfill-to")
    p.add_argument("--ingestion-ts", help="lineage timestamp (default: now, UTC)")
    p.add_argument("--mode-silver", default="replace", choices=MODES)
    p.add_argument("--mode-gold", default="replace", choices=MODES)
    p.add_argument("--gold-csv", help="also export the run's Gold rows as CSV here")
    p.add_argument("--quarantine", help="keep rejected rows (as delivered, with reason) here")
    p.add_argument("--skip-bronze", action="store_true")
    p.add_argument("--no-checks", action="store_true", help="do not stop a run that breaks a contract")
    p.add_argument("--on-arrival", metavar="CHECKPOINT",
                   help="run the days of the files landed since the last call with this checkpoint folder")
    p.add_argument("--app-name", default="riskmart-run")
    p.add_argument("--preview", type=int, default=0, help="print the first N Gold rows")
    return p.parse_args(argv)


def config_from(args: argparse.Namespace) -> RunConfig:
    extra = {k: v for k, v in {"ingestion_dates": args.ingestion_dates, "ingestion_ts": args.ingestion_ts,
                               "mode_silver": args.mode_silver, "mode_gold": args.mode_gold,
                               "gold_csv": args.gold_csv, "quarantine": args.quarantine,
                               "events_file": args.events_file, "reference_file": args.reference_file,
                               "check": False if args.no_checks else None}.items()
             if v is not None}
    if args.root:
        cfg = RunConfig.under(args.root, **extra)
    else:
        missing = [n for n in ("landing_events", "landing_reference", "bronze_events", "bronze_reference",
                               "silver", "gold") if getattr(args, n) is None]
        if missing:
            raise SystemExit(f"give --root or all of: {', '.join('--' + m.replace('_', '-') for m in missing)}")
        cfg = RunConfig(args.landing_events, args.landing_reference, args.bronze_events, args.bronze_reference,
                        args.silver, args.gold, **extra)
    overrides = {n: getattr(args, n) for n in ("landing_events", "landing_reference", "bronze_events",
                                               "bronze_reference", "silver", "gold") if getattr(args, n)}
    return RunConfig(**{**cfg.__dict__, **overrides})


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parse_args(argv)
    cfg = config_from(args)
    spark = spark or SparkSession.builder.appName(args.app_name).getOrCreate()
    if args.on_arrival:
        gold = run_arrived(spark, cfg, args.on_arrival)
    elif args.backfill_from or args.backfill_to:
        gold = backfill(spark, cfg, start=args.backfill_from, end=args.backfill_to)
    else:
        gold = run(spark, cfg, with_bronze=not args.skip_bronze)
    if args.preview and gold is not None:
        from riskmart.operators.bi import grain_order
        gold.orderBy(*grain_order()).show(args.preview, truncate=False)
    return gold


if __name__ == "__main__":
    main(sys.argv[1:])
