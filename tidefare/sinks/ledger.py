"""A ledger of demand windows: closed windows once, open ones as they stand, late requests kept, counts that last.

Each micro-batch reads the entry that the one before committed (its watermark, its open windows and its
counts) and writes, below its own batch number,

* `late`: requests whose window lies wholly before the watermark, as they came, with their window;
* `state`: the windows that were open or were touched, as mergeable sums, parted into those that the new
  watermark closes, which stand in no later batch, and those that stay open;
* `entry`: one row with the new watermark and the counts so far. It is written last: a batch is
  committed once its entry stands, and readers look at nothing beyond the newest entry.

So a batch that is repeated after a failure starts from the same entry, decides the same and
overwrites its own folders; one that was committed is left alone. What the windows do not count, `late`
holds: no request is lost or counted twice. The watermark is the greatest event time of all batches
before, less the allowed lateness, as in Spark's own windows. A batch's requests are combined per window and zone
before the shuffle; its state is the open windows alone, a row for each zone and window.

`compact` gathers the closed windows and the late requests of all batches so far in one *base*, written beside them and
committed by a mark of its own. Readers take the newest base and the batches after it, so compaction may run beside
the stream and beside readers. Batches below a base may be deleted once no reader began before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidefare.functions import surge
from tidefare.sinks.streams import _triggered
from tidefare.sources.tables import path_exists
from tidefare.streaming.windows import LATENESS, WINDOW, _arrival_order

KEYS = ("window_start", "window_end", "zone")
SUMS = ("total_requests", "drivers", "driver_rows", "rows")
STATE = (
    "window_start timestamp, window_end timestamp, zone string, total_requests bigint, drivers bigint, driver_rows bigint, rows bigint,"
    " arrival decimal(38,0), weather_code int, is_weekend boolean"
)
COUNTS = ("rows_read", "rows_late", "windows_closed")
ENTRY = "watermark timestamp, newest timestamp, rows_read bigint, rows_late bigint, windows_closed bigint"
CLOSES = "closes"


@dataclass(frozen=True)
class Ledger:
    """The tables of one ledger; `path` is a shared folder."""

    spark: SparkSession
    path: str

    def folder(self, table: str, batch_id: int) -> str:
        return f"{self.path}/{table}/batch_id={batch_id}"

    def entries(self) -> DataFrame:
        """The committed entries by `batch_id`; none before the first."""
        return self._stored("entry", f"{ENTRY}, batch_id bigint")

    def newest(self) -> dict | None:
        micros = [F.unix_micros(name).alias(name) for name in ("watermark", "newest")]
        row = self.entries().select("batch_id", *micros, *COUNTS).orderBy(F.desc("batch_id")).limit(1).first()
        return row.asDict() if row else None

    def counts(self) -> dict[str, int]:
        """Requests read, requests too late and windows closed since the ledger began, whatever was restarted in between."""
        entry = self.newest()
        return {name: entry[name] if entry else 0 for name in COUNTS}

    def base(self) -> int:
        """The batch that the newest base reaches, or -1."""
        return self._stored("base", "mark bigint").agg(F.coalesce(F.max("mark"), F.lit(-1))).first()[0]

    def closed(self) -> DataFrame:
        """Closed windows, each from its one writing, with ratio and surge."""
        return priced(self._closed_states())

    def open(self) -> DataFrame:
        """Windows that may still change, as of the newest entry."""
        entry = self.newest()
        return priced(self._open_states(entry["batch_id"] if entry else None))

    def windows(self) -> DataFrame:
        return self.closed().unionByName(self.open())

    def late(self, schema: T.StructType) -> DataFrame:
        """The requests that came after their window had closed; `schema` is that of the feed's requests."""
        bounds = [T.StructField(name, T.TimestampType()) for name in KEYS[:2]]
        return self._gathered("late", T.StructType([*schema.fields, *bounds]))

    def compact(self, schema: T.StructType, files: int | None = None) -> None:
        """Gather what the batches so far closed and found late; a mark written last commits it. `schema` as for `late`."""
        entry = self.newest()
        if entry is None or entry["batch_id"] <= self.base():
            return
        upto = entry["batch_id"]
        for name, rows in (("state", self._closed_states()), ("late", self.late(schema))):
            rows = rows if files is None else rows.repartition(files)
            rows.write.mode("overwrite").parquet(f"{self.path}/base_{name}/mark={upto}")
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/base/mark={upto}")

    def _closed_states(self) -> DataFrame:
        return self._gathered("state", T.StructType.fromDDL(STATE), closes=True)

    def _open_states(self, batch_id: int | None) -> DataFrame:
        if batch_id is None:
            return self.spark.createDataFrame([], STATE)
        rows = self._stored("state", f"{STATE}, batch_id bigint, {CLOSES} boolean")
        return rows.where((F.col("batch_id") == batch_id) & ~F.col(CLOSES)).drop("batch_id", CLOSES)

    def _gathered(self, table: str, schema: T.StructType, closes: bool | None = None) -> DataFrame:
        """Rows of the newest base and of the batches committed after it; other folders are pruned by their names."""
        entry, base = self.newest(), self.base()
        parts = [T.StructField("batch_id", T.LongType())] + ([T.StructField(CLOSES, T.BooleanType())] if closes is not None else [])
        rows = self._stored(table, T.StructType([*schema.fields, *parts]))
        rows = rows.where(F.col("batch_id").between(base + 1, entry["batch_id"] if entry else -1))
        if closes is not None:
            rows = rows.where(F.col(CLOSES) == closes)
        rows = rows.select(*schema.names)
        if base < 0:
            return rows
        marked = self._stored(f"base_{table}", T.StructType([*schema.fields, T.StructField("mark", T.LongType())]))
        return rows.unionByName(marked.where(F.col("mark") == base).select(*schema.names))

    def _stored(self, table: str, schema: T.StructType | str) -> DataFrame:
        """A table that may not have been written yet."""
        if not path_exists(self.spark, f"{self.path}/{table}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")


def partial_windows(requests: DataFrame, width: str) -> DataFrame:
    """Mergeable sums per window and zone; weather and weekend come from the earliest request."""
    return (
        requests.withColumn("arrival", _arrival_order())
        .groupBy(F.window("event_time", width).alias("window"), "zone")
        .agg(
            F.sum("ride_requests").cast("bigint").alias("total_requests"),
            F.sum("available_drivers").cast("bigint").alias("drivers"),
            F.count("available_drivers").alias("driver_rows"),
            F.count(F.lit(1)).alias("rows"),
            F.min("arrival").cast("decimal(38,0)").alias("arrival"),
            F.min_by("weather_code", "arrival").alias("weather_code"),
            F.min_by("is_weekend", "arrival").alias("is_weekend"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "zone", *SUMS, "arrival", "weather_code", "is_weekend")
    )


def merged(partials: DataFrame) -> DataFrame:
    carried = [F.min_by(name, "arrival").alias(name) for name in ("weather_code", "is_weekend")]
    return partials.groupBy(*KEYS).agg(*(F.sum(name).alias(name) for name in SUMS), F.min("arrival").alias("arrival"), *carried)


def priced(states: DataFrame) -> DataFrame:
    """States as windows with mean drivers, demand/supply ratio and surge."""
    with_mean = states.withColumn("avg_drivers", F.try_divide(F.col("drivers"), F.col("driver_rows")))
    with_ratio = with_mean.withColumn("demand_supply_ratio", surge.window_ratio(F.col("total_requests"), F.col("avg_drivers")))
    return with_ratio.select(
        *KEYS, "total_requests", "avg_drivers", "weather_code", "is_weekend", "demand_supply_ratio",
        surge.window_surge(F.col("demand_supply_ratio")).alias("surge_multiplier"),
    )


def write_ledger(
    requests: DataFrame, path: str, checkpoint: str, trigger: str | None = "15 seconds", width: str = WINDOW, lateness: str = LATENESS
) -> StreamingQuery:
    """Keep the windows of a stream of valid requests in the ledger at `path`; one checkpoint to a ledger, for good."""
    ledger = Ledger(requests.sparkSession, path)

    def keep(batch: DataFrame, batch_id: int) -> None:
        entry = ledger.newest()
        if entry and entry["batch_id"] >= batch_id:
            return  # committed before a restart
        entry = entry or {"batch_id": None, "watermark": None, "newest": None} | dict.fromkeys(COUNTS, 0)
        bounds = batch.withColumn("window", F.window("event_time", width))
        rows = bounds.select(*batch.columns, *(F.col(f"window.{end}").alias(name) for end, name in zip(("start", "end"), KEYS)))
        is_late = F.coalesce(F.col("window_end") <= F.timestamp_micros(F.lit(entry["watermark"]).cast("long")), F.lit(False))
        seen = rows.agg(F.max(F.unix_micros("event_time")).alias("newest"), F.count(F.lit(1)).alias("read"), F.count_if(is_late).alias("late")).first()
        newest = max((time for time in (seen["newest"], entry["newest"]) if time is not None), default=None)
        newest_time = F.timestamp_micros(F.lit(newest).cast("long"))
        watermark = newest_time - F.expr(f"INTERVAL {lateness}")
        rows.where(is_late).write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        fresh = partial_windows(rows.where(~is_late), width)
        states = merged(fresh.unionByName(ledger._open_states(entry["batch_id"])))
        closes = F.coalesce(F.col("window_end") <= watermark, F.lit(False))
        states.withColumn(CLOSES, closes).write.mode("overwrite").partitionBy(CLOSES).parquet(f"{path}/state/batch_id={batch_id}")
        stored = ledger._stored("state", f"{STATE}, batch_id bigint, {CLOSES} boolean")
        closed = stored.where((F.col("batch_id") == batch_id) & F.col(CLOSES)).count()
        added = zip(COUNTS, (seen["read"], seen["late"], closed))
        counts = [F.lit(entry[name] + value).cast("long").alias(name) for name, value in added]
        row = batch.sparkSession.range(0, 1, 1, 1).select(watermark.alias("watermark"), newest_time.alias("newest"), *counts)
        row.write.mode("overwrite").parquet(f"{path}/entry/batch_id={batch_id}")

    writer = requests.writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", checkpoint)
    return _triggered(writer, trigger).start()
