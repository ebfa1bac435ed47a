"""The daily run and its steps as commands; see ``python -m spotlift --help``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from spotlift.plans import daily_run
from spotlift.plans.ingest import ingest
from spotlift.plans.qa_report import EXPECTED_TABLES, QaConfig, QaError, run_qa
from spotlift.plans.quality_gate import QualityGateError
from spotlift.session import build_session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="spotlift", description="Ad-spot response marts, step by step or in one run.")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, about: str, *places: str) -> argparse.ArgumentParser:
        one = steps.add_parser(name, help=about)
        for place in places:
            one.add_argument(place)
        return one

    candidates = {"action": "store_true", "help": "with the table of all session and spot pairs"}
    step("ingest", "load the raw tables", "source_root")
    step("transform", "build staging, intermediate tables and marts").add_argument("--candidates", **candidates)
    step("gate", "store the quality checks, fail if any failed")
    step("export", "write the marts as CSV", "output_root")
    step("score", "score the spots, store and export the scores", "output_root", "model_folder")
    qa = step("qa", "write the QA report, fail if any check failed", "source_root", "report_path")
    qa.add_argument("--candidates", **candidates)
    qa.add_argument("--fail-fast", action="store_true")
    step("run", "all steps but qa", "source_root", "output_root", "model_folder").add_argument("--candidates", **candidates)
    return top


def perform(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.step == "ingest":
        ingest(spark, args.source_root)
    elif args.step == "transform":
        daily_run.transform(spark, args.candidates).show(truncate=False)
    elif args.step == "gate":
        daily_run.gate(spark)
    elif args.step == "export":
        daily_run.export_marts(spark, args.output_root)
    elif args.step == "score":
        daily_run.score(spark, args.output_root, args.model_folder)
    elif args.step == "qa":
        config = QaConfig(expected_tables=EXPECTED_TABLES) if args.candidates else QaConfig()
        run_qa(spark, args.source_root, args.report_path, config, args.fail_fast)
    else:
        places = args.source_root, args.output_root, args.model_folder
        daily_run.run_daily(spark, daily_run.RunConfig(*places, args.candidates))


def main(words: Sequence[str], spark: SparkSession | None = None) -> int:
    """The exit code: 1 if checks failed; any other error is raised."""
    args = parser().parse_args(words)
    try:
        perform(spark or build_session(f"spotlift {args.step}"), args)
    except (QaError, QualityGateError) as failed:
        print(failed, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
