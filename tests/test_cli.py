from __future__ import annotations

import pytest

from conformance import fixtures
from tidefare.__main__ import main
from tidefare.session import scratch_path
from tidefare.sinks.ledger import Ledger
from tidefare.sinks.streams import latest_windows


def test_jobs_end_to_end(spark, small, capsys):
    csv, out, model, predictions, cells = (
        scratch_path(spark, name) for name in ("csv", "out", "model", "predictions", "cells")
    )
    fixtures.raw_trips_as_exported(spark, small).write.option("header", True).csv(csv)
    main(["batch", "--trips", csv, "--out", out])
    assert "raw rows 1000, clean rows 671" in capsys.readouterr().out
    main(["train", "--features", f"{out}/features", "--model", model, "--predictions", predictions,
          "--trees", "3", "--depth", "3"])
    assert "rmse" in capsys.readouterr().out
    main(["dashboard", "--features", f"{out}/features", "--cells", cells, "--predictions", predictions,
          "--days", "Mon", "Sat", "--day-type", "Weekend Only"])
    shown = capsys.readouterr().out
    assert "kpis" in shown and "overall_error" in shown
    main(["dashboard", "--features", f"{out}/features", "--cells", cells, "--days", "Mon",
          "--day-type", "Weekend Only"])
    assert "no trips match" in capsys.readouterr().out
    main(["sample", "--trips", csv, "--copy", scratch_path(spark, "copy"),
          "--out", scratch_path(spark, "sample"), "--block-rows", "100", "--per-block", "20"])
    assert "sample rows" in capsys.readouterr().out


def test_feeds_end_to_end(spark, small):
    feed, windows, events = (scratch_path(spark, name) for name in ("feed", "windows", "events"))
    fixtures.messages(spark, small).write.text(feed)
    main(["windows", "--files", feed, "--out", windows, "--checkpoint", scratch_path(spark, "c1"), "--once"])
    assert latest_windows(spark, windows).count() == 987
    main(["events", "--files", feed, "--out", events, "--checkpoint", scratch_path(spark, "c2"), "--once"])
    assert spark.read.parquet(events).count() == 1000


def test_ledger_and_replays_from_the_command_line(spark, small, capsys):
    feed, ledger, events = (scratch_path(spark, name) for name in ("feed", "ledger", "events"))
    messages = fixtures.messages(spark, small)
    messages.unionByName(messages).write.text(feed)
    main(["windows", "--files", feed, "--ledger", ledger, "--checkpoint", scratch_path(spark, "c1"), "--once"])
    assert "rows_read 2000 rows_late 0" in capsys.readouterr().out
    main(["compact", "--ledger", ledger, "--files", "1"])
    assert Ledger(spark, ledger).base() >= 0 and Ledger(spark, ledger).windows().count() == 987
    main(["events", "--files", feed, "--out", events, "--checkpoint", scratch_path(spark, "c2"), "--once", "--horizon", "1 hour"])
    assert spark.read.parquet(events).count() == 1000


def test_kafka_jobs_ask_for_the_connector(spark):
    arguments = ["--servers", "localhost:9", "--checkpoint", scratch_path(spark, "c"), "--once"]
    for job in ("windows", "events"):
        with pytest.raises(Exception, match="(?i)kafka"):
            main([job, *arguments])


def test_bad_arguments_are_refused(spark):
    with pytest.raises(SystemExit):
        main(["events", "--files", "x", "--checkpoint", "y"])
    with pytest.raises(SystemExit):
        main(["dashboard", "--features", "x", "--cells", "y", "--days", "Someday"])
