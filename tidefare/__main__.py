"""Command line: `spark-submit ... -m tidefare <job>` or `python -m tidefare <job>`."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidefare.functions.calendar import DAY_NAMES
from tidefare.operators.dashboard import FilterSpec, apply_filter, has_rows
from tidefare.operators.trips import with_day_names
from tidefare.plans import dashboard, live
from tidefare.plans.batch import run_batch
from tidefare.plans.sample import stored_sample
from tidefare.plans.training import run_training
from tidefare.session import build_session
from tidefare.sinks.ledger import Ledger
from tidefare.sinks.streams import SURGE_TOPIC, console_windows
from tidefare.sources.requests import REQUEST_TOPIC, read_json_files, read_kafka
from tidefare.sources.tables import ROW_KEY, read_predictions_csv
from tidefare.sources.trips import read_features, read_trips_csv, read_trips_parquet
from tidefare.streaming.requests import parse_requests, valid_requests
from tidefare.streaming.windows import window_surge


def _show(title: str, rows: DataFrame, n: int = 50, out: str | None = None) -> None:
    """Print the first rows and say of how many; `out` is where all of them are written, in order."""
    if out:
        rows.write.mode("overwrite").parquet(f"{out}/{title}")
        rows = rows.sparkSession.read.parquet(f"{out}/{title}")
    total = rows.count()
    print(f"\n{title}: " + (f"first {n} of {total} rows" if total > n else f"{total} rows"))
    rows.show(n, truncate=False)


def _batch(spark: SparkSession, args: argparse.Namespace) -> None:
    keys = tuple(args.keys)
    read = read_trips_parquet if args.parquet else read_trips_csv
    raw = read(spark, args.trips, *keys)
    raw.printSchema()
    result = run_batch(raw, args.out, *keys, partition_by=args.partition_by)
    print(f"raw rows {result.raw_rows}, clean rows {result.clean_rows}")
    for name, report in result.reports.items():
        _show(name, report)


def _train(spark: SparkSession, args: argparse.Namespace) -> None:
    result = run_training(
        spark, args.features, args.model, args.predictions, *args.keys,
        trees=args.trees, depth=args.depth,
    )
    _show("metrics", result.metrics)
    _show("importances", result.importances)


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.servers:
        return read_kafka(spark, args.servers, topic=args.topic)
    return read_json_files(spark, args.files)


def _trigger(args: argparse.Namespace) -> str | None:
    return None if args.once else args.every


def _also_bad_records(messages: DataFrame, args: argparse.Namespace, timed: bool) -> None:
    if args.bad_out:
        bad = live.start_bad_records(messages, args.bad_out, f"{args.checkpoint}-bad", _trigger(args), timed)
        if args.once:
            bad.awaitTermination()


def _windows(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = _messages(spark, args)
    if args.ledger:
        query = live.start_window_ledger(messages, args.ledger, args.checkpoint, _trigger(args))
    elif args.out:
        query = live.start_window_surge(messages, args.out, args.checkpoint, _trigger(args))
    else:
        windows = window_surge(valid_requests(parse_requests(messages)))
        query = console_windows(windows, args.checkpoint, _trigger(args))
    _also_bad_records(messages, args, timed=True)
    query.awaitTermination()
    if args.ledger:
        print(" ".join(f"{name} {value}" for name, value in Ledger(spark, args.ledger).counts().items()))


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    nothing = spark.createDataFrame([], "value string")
    Ledger(spark, args.ledger).compact(valid_requests(parse_requests(nothing)).schema, args.files)


def _events(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = _messages(spark, args)
    if args.out:
        query = live.start_event_surge_files(messages, args.out, args.checkpoint, _trigger(args), args.horizon)
    else:
        query = live.start_event_surge_kafka(messages, args.servers, args.checkpoint, args.out_topic, _trigger(args), args.horizon)
    _also_bad_records(messages, args, timed=False)
    query.awaitTermination()


def _sample(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = stored_sample(
        spark, args.trips, args.copy, args.out, args.block_rows, args.per_block, args.max_blocks
    )
    print(f"sample rows {rows.count()}")


def _dashboard(spark: SparkSession, args: argparse.Namespace) -> None:
    spec = FilterSpec(
        days=tuple(args.days), first_hour=args.first_hour, last_hour=args.last_hour,
        surge_levels=args.surge, day_type=args.day_type,
    )
    features = read_features(spark, args.features, *args.keys)
    cells = dashboard.stored_cells(spark, features, args.cells)
    if not has_rows(apply_filter(cells, spec)):
        print("no trips match the filters")
        return
    for name, rows in dashboard.cell_datasets(cells, spec).items():
        _show(name, rows, out=args.out)
    keys = args.keys or [name for name in features.columns]
    for name, rows in dashboard.trip_datasets(with_day_names(features), *keys, spec=spec).items():
        _show(name, rows, 10, args.out)
    if args.predictions:
        scored = read_predictions_csv(spark, args.predictions, keyed=True)
        for name, rows in dashboard.prediction_datasets(scored, ROW_KEY).items():
            _show(name, rows, 10, args.out)


def _feed_arguments(job: argparse.ArgumentParser) -> None:
    source = job.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder of JSON lines")
    job.add_argument("--topic", default=REQUEST_TOPIC)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--bad-out", help="folder for messages that cannot be used")
    job.add_argument("--every", default="15 seconds", help="trigger interval")
    job.add_argument("--once", action="store_true", help="take what is there and stop")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tidefare", description=__doc__)
    jobs = root.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("batch", help="features, cells and reports from raw trips")
    job.add_argument("--trips", required=True)
    job.add_argument("--parquet", action="store_true", help="the trips are Parquet, not CSV")
    job.add_argument("--out", required=True)
    job.add_argument("--keys", nargs="*", default=[], help="key columns to keep")
    job.add_argument("--partition-by")
    job.set_defaults(run=_batch)

    job = jobs.add_parser("train", help="fit, evaluate and save the surge model")
    job.add_argument("--features", required=True)
    job.add_argument("--model", required=True)
    job.add_argument("--predictions", required=True)
    job.add_argument("--keys", nargs="*", default=[])
    job.add_argument("--trees", type=int, default=100)
    job.add_argument("--depth", type=int, default=8)
    job.set_defaults(run=_train)

    job = jobs.add_parser("windows", help="windowed surge per zone from a feed")
    _feed_arguments(job)
    target = job.add_mutually_exclusive_group()
    target.add_argument("--out", help="folder for upserted windows; the console if neither is given")
    target.add_argument("--ledger", help="folder for closed and open windows, late requests and lasting counts")
    job.set_defaults(run=_windows)

    job = jobs.add_parser("compact", help="gather the closed windows of a ledger")
    job.add_argument("--ledger", required=True)
    job.add_argument("--files", type=int, help="files to write")
    job.set_defaults(run=_compact)

    job = jobs.add_parser("events", help="surge and fare of each request of a feed")
    _feed_arguments(job)
    job.add_argument("--out", help="folder for messages; Kafka if absent")
    job.add_argument("--out-topic", default=SURGE_TOPIC, help="Kafka topic to publish to")
    job.add_argument("--horizon", help="price a message that comes again within this time once, such as '1 hour'")
    job.set_defaults(run=_events)

    job = jobs.add_parser("sample", help="a stored sample of labelled trips from CSV")
    job.add_argument("--trips", required=True)
    job.add_argument("--copy", required=True, help="folder for the Parquet copy of the trips")
    job.add_argument("--out", required=True)
    job.add_argument("--block-rows", type=int, default=500_000)
    job.add_argument("--per-block", type=int, default=10_000)
    job.add_argument("--max-blocks", type=int, help="only the first blocks")
    job.set_defaults(run=_sample)

    job = jobs.add_parser("dashboard", help="every dataset of one filtered dashboard view")
    job.add_argument("--features", required=True)
    job.add_argument("--cells", required=True, help="folder of the cells; made if it is missing")
    job.add_argument("--predictions", help="predictions CSV")
    job.add_argument("--out", help="folder for all rows of every dataset")
    job.add_argument("--keys", nargs="*", default=[])
    job.add_argument("--days", nargs="*", default=list(DAY_NAMES), choices=DAY_NAMES)
    job.add_argument("--first-hour", type=int, default=0)
    job.add_argument("--last-hour", type=int, default=23)
    job.add_argument("--surge", nargs="*", type=float)
    job.add_argument("--day-type", default="All", choices=("All", "Weekday Only", "Weekend Only"))
    job.set_defaults(run=_dashboard)
    return root


def main(arguments: Sequence[str] | None = None) -> None:
    root = parser()
    args = root.parse_args(arguments)
    if args.job == "events" and not (args.out or args.servers):
        root.error("events from files need --out")
    args.run(build_session(f"tidefare-{args.job}"), args)


if __name__ == "__main__":
    main()
