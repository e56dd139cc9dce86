"""Tables written to the shared folder, so that lost executors never repeat a long plan."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from paylater.context import shared_dir


# Rows of an Arrow batch while a table is written: with texts of some KB, a batch
# then is some MB, in the JVM's and in Python's memory.
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2000


_TRACKED: list[list[str]] = []


@contextmanager
def tracked() -> Iterator[list[str]]:
    """Collects the paths of the tables that are written inside."""
    paths: list[str] = []
    _TRACKED.append(paths)
    try:
        yield paths
    finally:
        _TRACKED[:] = [held for held in _TRACKED if held is not paths]       # not another list that is equal


def delete(spark, paths: list[str]) -> None:
    """Deletes tables that ``written`` made and that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        at = hadoop.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the session's checkpoint folder and read back."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_SETTING, before)
    for paths in _TRACKED:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)
