"""One small local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lexloom.session import build

    session = build("local[4]", "lexloom-tests", spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_ui_showConsoleProgress="false", spark_driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
