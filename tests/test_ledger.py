"""The window ledger: late rows, closed windows, replays, failures between two writes, compaction, lasting counts."""

from __future__ import annotations

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidefare.plans import live
from tidefare.sinks import ledger as ledgers
from tidefare.sinks.ledger import Ledger
from tidefare.sources.requests import read_json_files
from tidefare.streaming.requests import parse_requests, valid_requests


def request(time, zone="Uptown", requests=10):
    return json.dumps({"timestamp": f"2024-01-01T{time}", "zone": zone, "ride_requests": requests, "available_drivers": 5})


CHUNKS = [
    [request("10:00:00"), request("10:04:00"), request("10:04:30", None, 1)],
    [request("10:20:00", requests=7)],
    # An hour old, and behind the mark of 10:18: late. In the window that the mark has not passed: counted.
    [request("09:00:00", requests=3), request("10:14:59", requests=4), request("10:16:00", requests=5), request("10:19:30", requests=6)],
    [request("11:00:00", requests=8), "no message"],
]


def feed_of(folder, chunks=CHUNKS):
    folder.mkdir(exist_ok=True)
    for number, chunk in enumerate(chunks):
        path = folder / f"{number:03d}.json"
        if not path.exists():
            path.write_text("\n".join(chunk) + "\n")
            os.utime(path, (1_700_000_000 + number * 60,) * 2)
    return str(folder)


def run(spark, feed, tmp_path):
    messages = read_json_files(spark, feed, files_per_trigger=1)
    query = live.start_window_ledger(messages, str(tmp_path / "ledger"), str(tmp_path / "checkpoint"), trigger=None)
    query.awaitTermination()
    return Ledger(spark, str(tmp_path / "ledger"))


def totals(windows):
    return {(row.window_start.strftime("%H:%M"), row.zone): row.total_requests for row in windows.collect()}


def schema_of(spark):
    return valid_requests(parse_requests(spark.createDataFrame([], "value string"))).schema


CLOSED = {("10:00", "Uptown"): 20, ("10:00", None): 1, ("10:15", "Uptown"): 11, ("10:20", "Uptown"): 7}


def test_every_request_is_in_a_window_or_among_the_late(spark, tmp_path):
    ledger = run(spark, feed_of(tmp_path / "feed"), tmp_path)
    assert totals(ledger.closed()) == CLOSED and totals(ledger.open()) == {("11:00", "Uptown"): 8}
    late = ledger.late(schema_of(spark)).select(F.date_format("event_time", "HH:mm"), F.date_format("window_end", "HH:mm"), "ride_requests")
    assert Counter(tuple(row) for row in late.collect()) == Counter([("09:00", "09:05", 3), ("10:14", "10:15", 4)])
    assert ledger.counts() == {"rows_read": 9, "rows_late": 2, "windows_closed": 4}


def test_a_ledger_that_does_not_exist_yet_is_empty(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "none"))
    assert ledger.windows().count() == ledger.late(schema_of(spark)).count() == 0
    assert ledger.counts() == {"rows_read": 0, "rows_late": 0, "windows_closed": 0} and ledger.base() == -1
    ledger.compact(schema_of(spark))


def test_a_restart_adds_nothing_and_counts_last(spark, tmp_path):
    folder = tmp_path / "feed"
    first = run(spark, feed_of(folder, CHUNKS[:2]), tmp_path)
    assert first.counts() == {"rows_read": 4, "rows_late": 0, "windows_closed": 2}
    assert run(spark, feed_of(folder, CHUNKS[:2]), tmp_path).counts() == first.counts()
    again = run(spark, feed_of(folder), tmp_path)
    assert totals(again.closed()) == CLOSED and again.counts()["rows_read"] == 9


@pytest.mark.parametrize("table", ["late", "state", "entry"])
def test_a_batch_that_fails_between_two_writes_is_repeated_whole(spark, tmp_path, monkeypatch, table):
    """The third batch breaks right before it writes `table`; the restarted query repeats it."""
    from pyspark.sql import readwriter

    write, broken = readwriter.DataFrameWriter.parquet, []

    def failing(self, path, *args, **settings):
        if path.endswith(f"{table}/batch_id=2") and not broken:
            broken.append(path)
            raise RuntimeError("the executor is gone")
        return write(self, path, *args, **settings)

    monkeypatch.setattr(readwriter.DataFrameWriter, "parquet", failing)
    feed = feed_of(tmp_path / "feed")
    with pytest.raises(Exception, match="executor is gone"):
        run(spark, feed, tmp_path)
    half = Ledger(spark, str(tmp_path / "ledger"))
    assert half.counts() == {"rows_read": 4, "rows_late": 0, "windows_closed": 2} and half.late(schema_of(spark)).count() == 0
    assert totals(half.windows()) == {("10:00", "Uptown"): 20, ("10:00", None): 1, ("10:20", "Uptown"): 7}
    whole = run(spark, feed, tmp_path)
    assert broken and totals(whole.closed()) == CLOSED and whole.counts() == {"rows_read": 9, "rows_late": 2, "windows_closed": 4}


def test_a_committed_batch_that_comes_again_changes_nothing(spark, tmp_path, monkeypatch):
    """A crash after the entry and before the query's own commit: the batch is handed over once more."""
    feed = feed_of(tmp_path / "feed")
    expected = run(spark, feed, tmp_path)
    before = expected.counts()
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda path: int(path.name))
    commits[-1].unlink()
    for crc in (tmp_path / "checkpoint" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    again = run(spark, feed, tmp_path)
    assert again.counts() == before and totals(again.closed()) == CLOSED


def test_compaction_under_a_reader_and_a_running_feed(spark, tmp_path):
    folder = tmp_path / "feed"
    ledger = run(spark, feed_of(folder, CHUNKS[:3]), tmp_path)
    before, reader = totals(ledger.closed()), ledger.closed()
    ledger.compact(schema_of(spark), files=1)
    assert ledger.base() == ledger.newest()["batch_id"]
    assert totals(reader) == before == totals(ledger.closed())
    assert ledger.late(schema_of(spark)).count() == 2
    # A compaction that broke off before its mark is not seen.
    spark.createDataFrame([], ledgers.STATE).write.parquet(str(tmp_path / "ledger" / "base_state" / "mark=99"))
    assert totals(ledger.closed()) == before
    after = run(spark, feed_of(folder), tmp_path)
    assert totals(after.closed()) == CLOSED and after.counts()["windows_closed"] == 4
    after.compact(schema_of(spark))
    assert totals(after.closed()) == CLOSED
    stored = after.closed()
    assert all("base_state" in name for name in stored.inputFiles() if "closes" not in name)
