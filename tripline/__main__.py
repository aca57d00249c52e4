"""Run the layers from the command line: ``python -m tripline ingest | build | replace | answer``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from tripline.contract import DEFAULT_MONTHS, DEFAULT_YEAR, Lakehouse, Period
from tripline.operators.quality import assert_no_rows
from tripline.plans.answers import answer_avg_passenger_count_by_hour, answer_avg_total_amount_by_month
from tripline.plans.layers import create_all, create_gold, replace_months
from tripline.sources.fetch import failed_files, ingest_landing


def _arguments(arguments: list[str] | None) -> argparse.Namespace:
    months = argparse.ArgumentParser(add_help=False)
    months.add_argument("--landing", required=True, help="base folder of the landing area")
    months.add_argument("--year", type=int, default=DEFAULT_YEAR)
    months.add_argument("--months", type=int, nargs="+", default=list(DEFAULT_MONTHS))

    tables = argparse.ArgumentParser(add_help=False)
    tables.add_argument("--database", default=Lakehouse.database)
    tables.add_argument("--location", help="folder of the database, if not the warehouse default")
    tables.add_argument("--storage", default=Lakehouse.storage)

    layers = argparse.ArgumentParser(add_help=False)
    layers.add_argument("--start", type=date.fromisoformat, help="first pickup day; without it, the months loaded count")
    layers.add_argument("--end", type=date.fromisoformat, help="day after the last pickup day")
    layers.add_argument("--hourly", type=int, nargs=2, default=[2023, 5], metavar=("YEAR", "MONTH"),
                        help="the month whose hours of the day are compared")
    layers.add_argument("--trips-as", choices=["table", "view"], default="view")

    parser = argparse.ArgumentParser(prog="tripline", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    ingest = commands.add_parser("ingest", parents=[months], help="fetch monthly files into the landing area")
    ingest.add_argument("--published", required=True, help="base address of the published files")
    ingest.add_argument("--manifest", help="folder of the manifest")
    ingest.add_argument("--overwrite", action="store_true")
    ingest.add_argument("--mount", nargs=2, default=["file:", ""], metavar=("PREFIX", "FOLDER"),
                        help="how tasks reach the landing area: the start of its address, and what replaces it")
    commands.add_parser("build", parents=[months, tables, layers], help="build raw, silver and gold")
    commands.add_parser("replace", parents=[months, tables, layers], help="load some months again")
    commands.add_parser("answer", parents=[tables], help="show the two gold aggregates")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    chosen = _arguments(arguments)
    spark = SparkSession.builder.appName("tripline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if chosen.command == "ingest":
        manifest = ingest_landing(spark, chosen.published, chosen.landing, chosen.year, chosen.months,
                                  chosen.overwrite, chosen.manifest, tuple(chosen.mount))
        manifest.sort("year", "month").show(len(chosen.months), truncate=False)
        assert_no_rows(failed_files(manifest).select("year", "month", "status"), "files not landed")
        return
    lake = Lakehouse(chosen.database, chosen.location, chosen.storage)
    period = None
    if chosen.command != "answer" and (chosen.start or chosen.end):
        if not (chosen.start and chosen.end):
            raise SystemExit("--start and --end are given together")
        period = Period(chosen.start, chosen.end)
    if chosen.command == "build":
        create_all(spark, chosen.landing, chosen.year, chosen.months, lake, period, tuple(chosen.hourly),
                   chosen.trips_as)
    elif chosen.command == "replace":
        replace_months(spark, chosen.landing, chosen.months, chosen.year, lake, period)
        create_gold(spark, "overwrite", lake, *chosen.hourly, chosen.trips_as)
    monthly = answer_avg_total_amount_by_month(spark, lake)
    monthly.show(monthly.count())
    answer_avg_passenger_count_by_hour(spark, lake).show(24)


if __name__ == "__main__":
    main()
