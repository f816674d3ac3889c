from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"
GATE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidefare.session import build_session

    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def gate():
    return GATE


def plan_text(frame, mode: str = "formatted") -> str:
    execution = frame._jdf.queryExecution()
    return execution.explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
