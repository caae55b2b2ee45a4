"""Command line: one step of the daily run, or all of them.

    spark-submit ... -m terrace run --raw s3a://.../raw --root s3a://.../lake --date 2026-01-01

Steps: land, gate, silver, gold, test, publish, run, profile. With a date, each step works on
that date's load (or the one before it, where the date brought none); without one, on the newest. A failed gate or model test
ends with exit code 1.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import config
from terrace.operators.profile import profile
from terrace.operators.union import union_all
from terrace.plans import checks, pipeline
from terrace.session import drop_work_folder
from terrace.sources import bronze
from terrace.sources.tables import materialise, publish, read_table


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="terrace", description=__doc__.splitlines()[0])
    parser.add_argument("step", choices=["land", "gate", "silver", "gold", "test", "publish", "run", "profile"])
    parser.add_argument("--root", required=True, help="folder that holds bronze, silver, gold and runs")
    parser.add_argument("--raw", help="folder of the source files (land, run)")
    parser.add_argument("--date", help="load date, YYYY-MM-DD; every step reads what was loaded up to it")
    parser.add_argument("--resume", action="store_true", help="run: go on after the last good step of this date")
    parser.add_argument("--database", action="append", default=[], metavar="LAYER=NAME",
                        help="publish (and run): catalog database of silver or gold")
    parser.add_argument("--pattern", default="{entity}.csv", help="file name per entity")
    parser.add_argument("--file", action="append", default=[], metavar="ENTITY=NAME",
                        help="file name of one entity, overrides --pattern")
    parser.add_argument("--calendar-start", default=config.CALENDAR_START)
    parser.add_argument("--calendar-days", type=int, default=0,
                        help="a calendar of so many days; 0 spans the dates found in the data")
    args = parser.parse_args(argv)
    if args.step in ("land", "run") and not args.raw:
        parser.error(f"{args.step} needs --raw")
    if args.step in ("land", "silver", "gold", "run") and not args.date:
        parser.error(f"{args.step} needs --date")
    if any(pair.partition("=")[0] not in ("silver", "gold") for pair in args.database):
        parser.error("--database takes silver=NAME and gold=NAME")
    if args.step == "publish" and not args.database:
        parser.error("publish needs --database")
    return args


def _show(df: DataFrame) -> None:
    """Print a whole report, row by row; it has a row per file, column or rule."""
    print(*df.columns, sep="\t")
    for row in df.toLocalIterator():
        print(*row, sep="\t")


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"terrace {args.step}").getOrCreate()
    sources = config.sources(args.pattern, **dict(pair.split("=", 1) for pair in args.file))
    calendar = (args.calendar_start, args.calendar_days) if args.calendar_days else None
    places = pipeline.Places.under(args.root)
    databases = dict(pair.split("=", 1) for pair in args.database)
    try:
        match args.step:
            case "land":
                landing = bronze.land(spark, args.raw, places.bronze, args.date, sources)
                for name in landing.missing:
                    print(f"missing: {name}")
                _show(landing.manifest)
            case "gate":
                results = checks.raw_results(pipeline.parsed_raw(spark, places, sources, until=args.date)[0])
                return _verdict(results, "suite", "rule")
            case "silver":
                raw, forms = pipeline.parsed_raw(spark, places, sources, until=args.date)
                for written in pipeline.build_silver(spark, raw, places.silver, args.date, forms):
                    print(written.table, written.rows, written.metrics)
            case "gold":
                tables = {t: read_table(spark, places.silver, t, args.date) for t in config.SILVER_TABLES}
                for written in pipeline.build_gold(spark, tables, places.gold, args.date, calendar)[1]:
                    print(written.table, written.rows)
            case "test":
                gold = {t: read_table(spark, places.gold, t, args.date) for t in config.GOLD_TABLES}
                return _verdict(checks.model_results(gold), "model", "test")
            case "publish":
                for layer, tables in (("silver", config.SILVER_TABLES), ("gold", config.GOLD_TABLES)):
                    if layer in databases:
                        print(publish(spark, databases[layer], getattr(places, layer), tables, args.date))
            case "profile":
                raw = bronze.bronze_tables(spark, places.bronze, sources, until=args.date)
                _show(union_all(profile(materialise(df, f"raw-{name}"), name) for name, df in raw.items()))
            case "run":
                both = (databases["silver"], databases["gold"]) if len(databases) == 2 else None
                _show(pipeline.run(spark, args.raw, places, args.date, sources, calendar, both, args.resume))
    except checks.DataQualityError as failure:
        print(failure)
        return 1
    finally:
        drop_work_folder(spark)
    return 0


def _verdict(results: DataFrame, group: str, rule: str) -> int:
    results = materialise(results.withColumnRenamed(rule, "rule"), "verdict")
    _show(results.orderBy(group, "rule", "column"))
    _show(results.groupBy(group).agg(F.when(F.every("success"), "PASS").otherwise("FAIL").alias("status")))
    return int(not results.filter(~F.col("success")).isEmpty())


if __name__ == "__main__":
    sys.exit(main())
