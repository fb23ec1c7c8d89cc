"""Command-line driver: ``python -m tillbook <command> --source-dir DIR [...]``.

Commands mirror the reference's daily flow:

* ``seed``   — land the raw tables in ``--raw-dir``: from seed CSV files in
  ``--seed-dir`` (one folder or file per table) or, without it, derived from
  the source tables;
* ``append`` — land today's batch into the raw tables (idempotent per row);
* ``build``  — build every model, write intermediates, marts, reports and the
  check results under ``--out`` (default: a fresh folder in the shared
  storage root);
* ``check``  — run the 64 data-quality checks and print the failures;
* ``daily``  — ``append`` then ``build`` (the scheduled job).

Use with ``spark-submit`` on a cluster (the session is taken from the
submitting context) or stand-alone on local cores.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from tillbook.operators.quality import run_checks
from tillbook.plans.graph import Project
from tillbook.plans.pipeline import build_all
from tillbook.session import get_session
from tillbook.sources.schemas import RAW_SCHEMAS
from tillbook.sources.seeds import load_seed
from tillbook.sources.tables import land, read_raw_tables
from tillbook.streaming import daily


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillbook")
    parser.add_argument("command", choices=["seed", "append", "build", "check", "daily"])
    parser.add_argument("--seed-dir", help="seed CSVs, one folder or file per raw table")
    parser.add_argument("--quarantine-dir", help="folder for malformed seed lines (default: one fails the load)")
    parser.add_argument("--source-dir", required=True, help="folder with the source parquet tables")
    parser.add_argument("--raw-dir", help="landed raw tables (default: derive them from the sources)")
    parser.add_argument("--out", help="output folder for a build")
    parser.add_argument("--as-of", help="reference clock, 'YYYY-MM-DD HH:MM:SS' (default: now, UTC)")
    args = parser.parse_args(argv)

    as_of = args.as_of or dt.datetime.now(dt.UTC).strftime("%Y-%m-%d %H:%M:%S")
    spark = get_session()
    project = Project.from_dir(spark, args.source_dir, as_of=as_of)
    if args.command == "seed":
        if not args.raw_dir:
            parser.error("seed needs --raw-dir")
        for table in RAW_SCHEMAS:
            if args.seed_dir:
                load_seed(spark, f"{args.seed_dir.rstrip('/')}/{table}", table, args.raw_dir, args.quarantine_dir)
            else:
                land(project.table(table), args.raw_dir, table, mode="overwrite")
        print(json.dumps({"raw_dir": args.raw_dir, "tables": list(RAW_SCHEMAS)}))
        return
    if args.command in ("append", "daily"):
        if not args.raw_dir:
            parser.error("append needs --raw-dir (the landed raw tables to append to)")
        batches = daily.daily_batches(project.sources, project.as_of_text)
        reports = daily.append_daily_batch(spark, args.raw_dir, batches, project.as_of_text)
        print(json.dumps([r.__dict__ for r in reports]))
    if args.raw_dir:
        project = Project(spark, project.sources, raw=read_raw_tables(spark, args.raw_dir), as_of=project.as_of_text)
    if args.command in ("build", "daily"):
        result = build_all(project, args.out)
        print(json.dumps({"root": result.root, "seconds": result.seconds}))
    if args.command == "check":
        for row in run_checks(project).where("NOT passed").collect():
            print(json.dumps(row.asDict()))


if __name__ == "__main__":
    main()
