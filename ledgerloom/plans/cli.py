"""Command line: one sub-command per stage."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from ledgerloom.operators.quality import ValidationFailed
from ledgerloom.params import Params
from ledgerloom.plans import stages
from ledgerloom.plans.stages import Layout, StageMissing
from ledgerloom.session import build_session


def _data(spark: SparkSession, args: argparse.Namespace, layout: Layout, params: Params) -> None:
    report = stages.run_data(spark, args.raw, layout, params).first().asDict()
    print(", ".join(f"{name}={count}" for name, count in sorted(report.items())))


def _features(spark: SparkSession, args: argparse.Namespace, layout: Layout, params: Params) -> None:
    for name, table in stages.run_features(spark, layout, params).items():
        print(f"{name}: {table.count()} rows, {len(table.columns)} columns")


def _train(spark: SparkSession, args: argparse.Namespace, layout: Layout, params: Params) -> None:
    stages.run_train(spark, layout, params).select("model", "run_id", "metrics").show(truncate=False)


def _promote(spark: SparkSession, args: argparse.Namespace, layout: Layout, params: Params) -> None:
    stages.run_promote(spark, layout).show(truncate=False)


def _monitor(spark: SparkSession, args: argparse.Namespace, layout: Layout, params: Params) -> None:
    stages.run_monitor(spark, layout, params).show(truncate=False, vertical=True)


COMMANDS = {"data": _data, "features": _features, "train": _train, "promote": _promote, "monitor": _monitor}


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in COMMANDS:
        command = commands.add_parser(name)
        command.add_argument("--base", required=True, help="folder of the stage tables")
        command.add_argument("--master", default=None)
        if name == "data":
            command.add_argument("--raw", required=True, help="folder of raw transaction files")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    spark = build_session(master=args.master)
    try:
        COMMANDS[args.command](spark, args, Layout(args.base), Params.from_spark(spark))
    except (ValidationFailed, StageMissing, FileNotFoundError, ValueError, AnalysisException) as problem:
        print(f"error: {problem}", file=sys.stderr)
        return 1
    return 0
