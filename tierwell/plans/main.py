"""Runs the jobs: ``spark-submit tierwell/plans/main.py bronze silver gold --landing ... --storage ...``."""

import argparse
import datetime
import sys
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tierwell.config import RunConfig  # noqa: E402
from tierwell.plans import bronze, gold, silver  # noqa: E402

LAYERS = ("bronze", "silver", "gold")


def _area_and_day(text: str) -> tuple[str, str]:
    area, day = text.split(":")
    return area, datetime.date.fromisoformat(day).isoformat()


def parse(arguments) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Load landed files and build the tables, layer by layer.")
    parser.add_argument("layers", nargs="+", choices=LAYERS, help="run in the order bronze, silver, gold")
    parser.add_argument("--landing", required=True, help="folder with the landed files")
    parser.add_argument("--storage", required=True, help="folder for the tables")
    parser.add_argument("--prefix", default="", help="schema prefix, such as dev_")
    parser.add_argument("--run-id", default="manual", help="tags the rows of the quality log")
    parser.add_argument("--as-of", type=datetime.date.fromisoformat, help="the day to take as today")
    parser.add_argument("--known-missing", type=_area_and_day, nargs="*", default=[], metavar="AREA:DAY",
                        help="price days that do not exist and need no file")
    parser.add_argument("--only-touched", action="store_true", help="silver: only periods loaded since the last merge")
    return parser.parse_args(arguments)


def main(arguments=None) -> None:
    options = parse(arguments)
    spark = SparkSession.builder.appName("tierwell").getOrCreate()
    config = RunConfig(
        landing=options.landing, storage=options.storage, prefix=options.prefix, run_id=options.run_id,
        as_of=options.as_of, known_missing_days=tuple(options.known_missing),
    )
    jobs = {
        "bronze": lambda: bronze.run(spark, config),
        "silver": lambda: silver.run(spark, config, options.only_touched),
        "gold": lambda: gold.run(spark, config),
    }
    for layer in LAYERS:
        if layer in options.layers:
            for table, result in jobs[layer]().items():
                print(f"{layer} {table}: {result}")


if __name__ == "__main__":
    main()
