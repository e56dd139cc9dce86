from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paylater.context import RunContext  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="paylater-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("paylater-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.shuffle.accurateBlockSkewedFactor", "5")      # as build_session sets it
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="paylater-test-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture
def ctx():
    return RunContext(as_of=dt.date(2001, 8, 2), calendar_start=dt.date(2000, 1, 1))


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)
