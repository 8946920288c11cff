"""Command line: export a dataset, or report on coverage or on what each day holds.

    python -m tickloom.cli export --config c.toml [--force]
    python -m tickloom.cli coverage --config c.toml [--date YYYY-MM-DD]
    python -m tickloom.cli profile --config c.toml [--date YYYY-MM-DD]
"""

from __future__ import annotations

import argparse
import sys
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import Config, iso
from tickloom.operators import calendar, context
from tickloom.plans import export, manifest, reports
from tickloom.sources import feed, files, stores


def daily(spark: SparkSession, cfg: Config) -> DataFrame:
    """The configured daily summary as context, or an empty one."""
    path = cfg.input.daily_summary_path
    return context.daily_context(spark.read.parquet(path)) if path else context.empty_context(spark)


def wanted(spark: SparkSession, cfg: Config, date: str | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(events, decode counters, (trade_date, path) of the files): the days asked for that have a file; days without one are named on stderr. Delimited files and feeds can hold bad rows, and have counters."""
    start, end = (date, date) if date else (cfg.dates.start_date, cfg.dates.end_date)
    if date:
        iso(date)
    days = calendar.weekdays(spark, start, end, () if date else cfg.dates.exclude_dates)
    found = files.discover(spark, cfg.input.data_dir, cfg.input.filename_pattern)
    for r in calendar.missing(days, found).orderBy("trade_date").collect():  # one row a day of the calendar
        print(f"no file for {r.trade_date}", file=sys.stderr)
    there = calendar.available(days, found)
    paths = [r.path for r in there.orderBy("trade_date").collect()]
    if not paths:
        raise FileNotFoundError("no day has a file")
    delimited, feeds = ([p for p in paths if p.endswith(kind)] for kind in (".csv", feed.SUFFIX))
    other = [p for p in paths if not p.endswith((".csv", feed.SUFFIX))]
    named = lambda df: df.withColumn("symbol", F.coalesce("symbol", F.lit(cfg.input.symbol)))
    parts, reports = [named(files.read_events(spark, other))] if other else [], []
    found = [files.decode_report(named(files.read_tolerant(spark, delimited)))] if delimited else []
    found += [feed.decoded(feed.read_feed(spark, feeds))] if feeds else []
    for good, report in found:
        parts.append(good)
        reports.append(report)
    return reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, reports) if reports else None, there.select("trade_date", "path")


def printed(rows: DataFrame) -> None:
    """All rows as lines of tab-separated values, a partition at a time."""
    print("\t".join(rows.columns))
    for r in rows.toLocalIterator():
        print("\t".join(map(str, r)))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tickloom", description=__doc__.splitlines()[0])
    parser.add_argument("command", choices=("export", "coverage", "profile"))
    parser.add_argument("--config", required=True)
    parser.add_argument("--date")
    parser.add_argument("--force", action="store_true")
    args = parser.parse_args(argv)
    cfg = Config.from_toml(args.config)
    spark = SparkSession.builder.appName("tickloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "export":
        root = cfg.export.output_dir
        manifest.guard(root, args.force)
        ctx = daily(spark, cfg) if cfg.input.daily_summary_path else None
        events, decode, there = wanted(spark, cfg)
        source = stores.digests(there).select("trade_date", F.element_at(F.split("path", "/"), -1).alias("source_file"), F.col("sha256").alias("data_file_sha256"))
        found = export.export_dataset(events, cfg, root, ctx, decode, source)
        stores.put(f"{root.rstrip('/')}/export_config.toml", Path(args.config).read_bytes())
        print(f"{found['total_sequences']} sequences, complete: {found['complete']}")
        return 0 if found["complete"] else 1
    events, *_ = wanted(spark, cfg, args.date)
    if args.command == "profile":
        printed(reports.profile_report(events, cfg).orderBy("symbol", "trade_date"))
        return 0
    by_day = reports.coverage_report(events, daily(spark, cfg), cfg)
    printed(by_day.orderBy("symbol", "trade_date"))
    context.coverage_summary(by_day).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
