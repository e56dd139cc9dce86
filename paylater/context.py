"""Run parameters, session construction and the shared working folder."""

from __future__ import annotations

import datetime as dt
import os
import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the reference: the calendar dimension starts here and runs
# three years past the run date.
DEFAULT_CALENDAR_START = dt.date(2020, 1, 1)
CALENDAR_YEARS_AHEAD = 3


@dataclass(frozen=True)
class RunContext:
    """The only clock in the library.

    ``as_of`` replaces ``current_date()``; ``updated_at`` replaces
    ``current_timestamp``; ``extracted_at`` is the bronze lineage stamp.
    All timestamps are zone-less (``timestamp_ntz``), like the source data.
    """

    as_of: dt.date
    updated_at: dt.datetime | None = None
    extracted_at: dt.datetime | None = None
    calendar_start: dt.date = DEFAULT_CALENDAR_START
    calendar_end: dt.date | None = None  # exclusive; default as_of + 3 years

    def _midnight(self) -> dt.datetime:
        return dt.datetime.combine(self.as_of, dt.time())

    @property
    def as_of_col(self) -> Column:
        return F.lit(self.as_of)

    @property
    def as_of_ts(self) -> Column:
        """``as_of`` at midnight, as ``timestamp_ntz``."""
        return ntz_literal(self._midnight())

    @property
    def updated_at_col(self) -> Column:
        return ntz_literal(self.updated_at or self._midnight())

    @property
    def extracted_at_col(self) -> Column:
        return ntz_literal(self.extracted_at or self._midnight())

    @property
    def calendar_end_exclusive(self) -> dt.date:
        if self.calendar_end is not None:
            return self.calendar_end
        try:
            return self.as_of.replace(year=self.as_of.year + CALENDAR_YEARS_AHEAD)
        except ValueError:  # 29 Feb
            return self.as_of.replace(year=self.as_of.year + CALENDAR_YEARS_AHEAD, day=28)


def ntz_literal(value: dt.datetime) -> Column:
    """A zone-less timestamp literal (``F.lit`` of a datetime is zoned)."""
    return F.to_timestamp_ntz(F.lit(value.strftime("%Y-%m-%d %H:%M:%S")))


# Run date used by every registered query and by the fixtures.
TEST_CONTEXT = RunContext(
    as_of=dt.date(2001, 8, 2),
    calendar_start=dt.date(2000, 1, 1),
)


# Shuffle partitions before AQE merges them: at 128 MB each, 2.5 TB a shuffle.
INITIAL_PARTITIONS = 20_000


def _half_of_memory() -> str:
    total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    return f"{max(1, total // 2 >> 30)}g"


def build_session(master: str | None = None, app_name: str = "paylater",
                  shuffle_partitions: int | None = None,
                  advisory_partition_bytes: str | None = None) -> SparkSession:
    """Session with the settings the library is tuned for.

    AQE re-plans joins at runtime (broadcast only when the measured side is
    under the threshold), coalesces small shuffle partitions and splits
    skewed ones (one merchant may hold a third of all rows).  On a cluster
    keep the default advisory partition size (64 MB); for a few MB of local
    test data a smaller one keeps all cores busy after a shuffle.  With more
    than 2,000 partitions Spark reports only mean block sizes of a map task, which hides a hot
    partition; ``accurateBlockSkewedFactor`` has it report the large blocks.

    A session that runs already is returned as it is.
    """
    if SparkContext._active_spark_context is not None:
        return SparkSession.builder.getOrCreate()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.shuffle.accurateBlockSkewedFactor": "5",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    local = bool(master and master.startswith("local"))
    if local:
        # one JVM: its heap gets half of the host's memory; about one shuffle
        # partition per core suits a few MB of test data
        conf["spark.driver.memory"] = _half_of_memory()
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or os.cpu_count() or 8)
    else:
        # on a cluster AQE starts from many partitions and merges small ones down
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            shuffle_partitions or INITIAL_PARTITIONS)
    if advisory_partition_bytes:
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = advisory_partition_bytes
        conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = advisory_partition_bytes
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The directory is read from the session (``spark.checkpoint.dir`` or the
    context's checkpoint directory).  Only when neither is set and Spark runs
    in one process (local tests) is a folder under the system temp area
    registered as the checkpoint directory; on a cluster a missing setting is an
    error, because executors don't share such a folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="paylater-ckpt-"))
        base = spark.sparkContext.getCheckpointDir()
    sub = f"{name or 'work'}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + sub
