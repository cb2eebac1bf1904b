"""Command line, for ``spark-submit`` or ``python -m stardw``.

    load    stage, transform and publish; only orders after the high-water mark
    order   follow one order through the load without publishing it
    ask     answer a business question
    verify  row counts, contracts, best sales staff and the quality reports
    log     the last runs
    push    copy the published tables to a database
    compact write the months anew that small loads have left in many folders
    wipe    publish every table empty
    expire  delete folders that recent publications do not name, and what dead drivers left
"""

from __future__ import annotations

import argparse
import json
from datetime import UTC, date, datetime
from pathlib import Path

from stardw.plans import analytics, controls, meta, pipeline, verify
from stardw.session import build_session, sweep
from stardw.sources import deltas
from stardw.sources.jdbc import JdbcSource, push
from stardw.sources.retail_parquet import RetailParquet
from stardw.sources.snapshots import Warehouse


def parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser("stardw", description=__doc__,
                                   formatter_class=argparse.RawDescriptionHelpFormatter)
    made.add_argument("--warehouse", required=True, help="folder of the warehouse")
    made.add_argument("--properties", type=Path, help="JSON file with what the database driver "
                      "needs: user, password, driver")
    made.add_argument("--master", help="Spark master, where spark-submit does not set it")
    commands = made.add_subparsers(dest="command", required=True)

    def command(name: str, source: bool = False) -> argparse.ArgumentParser:
        one = commands.add_parser(name)
        if source:
            where = one.add_mutually_exclusive_group(required=True)
            where.add_argument("--parquet", help="folder of the operational parquet tables")
            where.add_argument("--jdbc", help="URL of the operational database")
            one.add_argument("--as-of", type=date.fromisoformat,
                             default=datetime.now(UTC).date(), help="day of the load")
        return one

    load = command("load", source=True)
    load.add_argument("--lookback-days", type=int, default=0)
    load.add_argument("--dates", nargs=2, type=date.fromisoformat, metavar=("FIRST", "LAST"),
                      help="days of the date dimension on the first load")
    command("order", source=True).add_argument("--id", type=int, help="default: the lowest")
    ask = command("ask")
    ask.add_argument("question", choices=sorted(analytics.QUESTIONS))
    ask.add_argument("arguments", nargs="*", help="e.g. a country and a year, or a group")
    command("verify")
    command("skipped", source=True)
    command("log").add_argument("--last", type=int, default=20)
    command("push").add_argument("--jdbc", required=True)
    command("compact").add_argument("--most", type=int, default=deltas.MOST_LOTS,
                                    help="folders of a month beyond which it is written anew")
    command("wipe")
    command("expire").add_argument("--keep", type=int, default=7)
    return made


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(master=args.master)
    warehouse = Warehouse(spark, args.warehouse)
    # In a file, so that no password stands in a URL or on the command line.
    properties = json.loads(args.properties.read_text()) if args.properties else {}

    def source():
        return (RetailParquet(spark, args.parquet) if args.parquet
                else JdbcSource(spark, args.jdbc, **properties))

    match args.command:
        case "load":
            pipeline.run(source(), warehouse, args.as_of, lookback_days=args.lookback_days,
                         span=tuple(args.dates) if args.dates else None)
        case "order":
            pipeline.run_single_order(source(), warehouse, args.as_of, args.id).show(
                truncate=False)
        case "ask":
            values = [int(a) if a.isdigit() else a for a in args.arguments]
            analytics.QUESTIONS[args.question](warehouse, *values).show(100, truncate=False)
        case "verify":
            for report in (verify.row_counts, verify.contracts, verify.top_reps,
                           controls.fact_orphans, controls.unique_keys):
                report(warehouse).show(100, truncate=False)
        case "skipped":
            controls.skipped_orders(source(), warehouse).orderBy("date_commande").show(
                10_000, truncate=False)
        case "log":
            meta.RunLog(warehouse).latest(args.last).show(args.last, truncate=False)
        case "push":
            push(warehouse, args.jdbc, **properties)
        case "compact":
            pipeline.compact(warehouse, most=args.most)
        case "wipe":
            pipeline.wipe(warehouse)
        case "expire":
            print("\n".join([*warehouse.expire(args.keep), *sweep(spark)]))


if __name__ == "__main__":
    main()
