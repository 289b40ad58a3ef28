"""Command line: ``python -m tourney run|test|ingest|tidy`` (or through ``spark-submit``)."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tourney.plans.build import LAYERS, build, register_gold, register_silver, tidy
from tourney.plans.quality import dq_report
from tourney.session import scratch_table
from tourney.sources.bronze import bronze_in_order, read_bronze
from tourney.streaming.ingest import ingest_new_runs


def _arguments(args: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tourney")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="rebuild the selected layers from bronze")
    run.add_argument("--bronze", required=True)
    run.add_argument("--warehouse", required=True)
    run.add_argument("--select", choices=LAYERS, help="one layer; both without it")
    run.add_argument("--register", action="store_true", help="also create the gold tables")
    run.add_argument("--database", help="of the silver view and the gold tables")
    _add_order(run)
    test = commands.add_parser("test", help="check bronze; fails if a rule is broken")
    test.add_argument("--bronze", required=True)
    test.add_argument("--last-tour", type=int, help="highest allowed round number")
    test.add_argument("--run-id-chars", type=int, help="required length of run ids")
    ingest = commands.add_parser("ingest", help="load new run files and rebuild their runs")
    for name in ("--landing", "--bronze", "--warehouse", "--checkpoint"):
        ingest.add_argument(name, required=True)
    _add_order(ingest)
    joined = commands.add_parser("tidy", help="join small batches and versions, remove unused ones")
    joined.add_argument("--bronze")
    joined.add_argument("--warehouse", required=True)
    joined.add_argument("--hours", type=float, default=168, help="younger folders stay")
    return parser.parse_args(args)


def _add_order(parser: argparse.ArgumentParser) -> None:
    parser.add_argument(
        "--order",
        choices=("tour", "position"),
        default="tour",
        help="position: for many copies of a round, or very sparse round numbers",
    )


def _build_gold(spark: SparkSession, given: argparse.Namespace) -> None:
    if given.order == "position":
        with scratch_table(bronze_in_order(spark, given.bronze), "in-order") as rounds:
            build(rounds, given.warehouse, select=("gold",), order=given.order)
    else:
        build(read_bronze(spark, given.bronze), given.warehouse, select=("gold",))
    if given.register:
        register_gold(spark, given.warehouse, given.database)


def main(args: Sequence[str] | None = None) -> int:
    given = _arguments(args)
    spark = SparkSession.builder.appName(f"tourney-{given.command}").getOrCreate()
    if given.command == "run":
        if given.select != "gold":
            register_silver(spark, given.bronze, given.database)
        if given.select != "silver":
            _build_gold(spark, given)
    elif given.command == "test":
        bronze = read_bronze(spark, given.bronze)
        report = dq_report(bronze, last_tour=given.last_tour, run_id_chars=given.run_id_chars)
        rows = report.orderBy("rule").collect()
        for row in rows:
            print(f"{row.rule}: {row.violations} of {row.checked}")
        return int(any(row.violations for row in rows))
    elif given.command == "tidy":
        tidy(spark, given.warehouse, given.hours, given.bronze)
    else:
        ingest_new_runs(
            spark, given.landing, given.bronze, given.warehouse, given.checkpoint, given.order
        ).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
