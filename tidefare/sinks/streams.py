"""Streaming sinks. All take a checkpoint location, so a restart neither loses nor repeats rows."""

from __future__ import annotations

import json
import time
from collections import Counter
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SURGE_TOPIC = "surge-output"
WINDOW_KEYS = ("window_start", "window_end", "zone")


def _triggered(writer, trigger: str | None):
    """A trigger interval such as "15 seconds", or None to take what is there and stop."""
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def upsert_windows(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "15 seconds",
    files: int | None = None,
) -> StreamingQuery:
    """Keep the changed windows of each micro-batch under their run and batch number.

    The run is the identity that the checkpoint holds: rewriting a batch replaces its own folder,
    so a replay after a failure changes nothing, and a new checkpoint on the same `path` never
    touches what an older one wrote. `latest_windows` reads the version of every window that was
    written last. A batch is written in `files` files, or else in one per state partition.
    """
    run: list[str] = []

    def keep(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"])
        rows = (batch if files is None else batch.repartition(files)).withColumn("written", F.lit(time.time_ns()))
        rows.write.mode("overwrite").parquet(f"{path}/run={run[0]}/batch_id={batch_id}")

    writer = windows.writeStream.outputMode("update").foreachBatch(keep)
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()


def _newest(rows: DataFrame) -> DataFrame:
    """The rows of each window's last writing; keys and stamp are of fixed width but the zone, so both steps hash."""
    last = rows.groupBy(*WINDOW_KEYS).agg(F.max("written").alias("written"))
    same = [F.col(f"r.{name}").eqNullSafe(F.col(f"l.{name}")) for name in (*WINDOW_KEYS, "written")]
    return rows.alias("r").join(last.alias("l"), reduce(and_, same), "left_semi")


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """One row per window and zone, from the batch that changed it last."""
    return _newest(spark.read.parquet(path)).drop("run", "batch_id", "written")


def compact_windows(spark: SparkSession, path: str, out: str) -> None:
    """Write only the last version of every window to the new folder `out`, for `latest_windows` to read."""
    rows = _newest(spark.read.parquet(path)).drop("run", "batch_id")
    rows.write.parquet(f"{out}/run=compacted/batch_id=0")


def console_windows(
    windows: DataFrame, checkpoint: str, trigger: str | None = "15 seconds"
) -> StreamingQuery:
    """Show the changed windows of each micro-batch."""
    writer = windows.writeStream.outputMode("update").format("console").option("truncate", False)
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()


def publish_kafka(
    messages: DataFrame,
    servers: str,
    checkpoint: str,
    topic: str = SURGE_TOPIC,
    trigger: str | None = "1 second",
) -> StreamingQuery:
    """Publish (key, value) rows; needs the Kafka connector on the session's classpath."""
    writer = (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()


def append_files(
    rows: DataFrame, path: str, checkpoint: str, trigger: str | None = "15 seconds"
) -> StreamingQuery:
    """Append rows to a Parquet folder, each exactly once."""
    writer = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()


class FeedCounter(StreamingQueryListener):
    """Rows read and rows dropped as late of every query since the listener was added.

    A query itself only remembers its last hundred triggers. Add with `spark.streams.addListener`.
    """

    def __init__(self) -> None:
        self.read: Counter[str] = Counter()
        self.late: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.read[str(progress.id)] += progress.numInputRows
        self.late[str(progress.id)] += sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def rows_read(query: StreamingQuery) -> int:
    """Rows of the last hundred triggers; `FeedCounter` has them all."""
    return sum(progress.numInputRows for progress in query.recentProgress)


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows of the last hundred triggers that came after their window had closed."""
    return sum(
        state.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for state in progress.stateOperators
    )
