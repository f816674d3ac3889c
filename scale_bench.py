"""Times the jobs on as many trips as the month that the published figures are about.

The given events are repeated with new ids to 12.2 million rows and written as CSV, once, into
a new folder; SCALE_DIR names an earlier one to use again.
"""

from __future__ import annotations

import os
import tempfile
import time

from pyspark.sql import functions as F

from bench import SF_DIR, session
from conformance import fixtures
from tidefare.plans.batch import run_batch
from tidefare.plans.dashboard import cell_datasets
from tidefare.plans.sample import stored_sample
from tidefare.sources.trips import read_trips_csv

ROWS = 12_210_952


def write_month(spark, path: str) -> None:
    rows = fixtures.events(spark, SF_DIR)
    stored = rows.count()
    copies = F.explode(F.sequence(F.lit(0), F.lit(ROWS // stored)))
    month = (
        rows.repartition(16)
        .select("*", copies.alias("copy"))
        .withColumn("event_id", F.col("event_id") + F.col("copy").cast("long") * stored)
        .filter(F.col("event_id") < ROWS)
    )
    fixtures.exported(fixtures.trips_from_events(month)).write.option("header", True).csv(path)


def timed(label: str, work) -> None:
    start = time.perf_counter()
    result = work()
    print(f"{label:52s} {time.perf_counter() - start:8.1f} s   {result}")


def main() -> None:
    spark = session()
    root = os.environ.get("SCALE_DIR")
    if root is None:
        root = tempfile.mkdtemp(prefix="month-")
        timed(f"write the month as CSV to {root}", lambda: write_month(spark, f"{root}/csv"))
    out = tempfile.mkdtemp(prefix="jobs-", dir=root)
    results = {}

    def batch():
        results["batch"] = found = run_batch(read_trips_csv(spark, f"{root}/csv"), f"{out}/batch")
        return f"{found.raw_rows} raw, {found.clean_rows} clean"

    def reports():
        return {name: len(rows.collect()) for name, rows in results["batch"].reports.items()}

    def view():
        return {name: len(rows.collect()) for name, rows in cell_datasets(results["batch"].cells).items()}

    def sample():
        return stored_sample(spark, f"{root}/csv", f"{out}/trips", f"{out}/sample").count()

    timed("CSV to features and cells", batch)
    timed("five reports", reports)
    timed("seven dashboard datasets from cells", view)
    timed("block sample from CSV, by way of Parquet", sample)
    timed("stored sample again", sample)
    spark.stop()


if __name__ == "__main__":
    main()
