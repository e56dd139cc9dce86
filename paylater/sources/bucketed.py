"""Tables bucketed by a join key, so that joins on it need no shuffle.

A bucketed copy belongs to one version of its source: its folder is named after the source's files, the key and
the number of buckets.  A source that has grown or was loaded again therefore gets a new copy, and
a write that broke off is never read (it has no ``_SUCCESS``).  Copies outlive the session: the
catalog entry is made again over the files.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from paylater.sources.bronze import _files

NAMESPACE = "joins"


def version(source: DataFrame, key: str, buckets: int, columns: list[str]) -> str:
    """Names the files that ``source`` reads, and how they are bucketed."""
    parts = [key, str(buckets), *columns, *sorted(source.inputFiles())]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:24]


def bucketed(source: DataFrame, name: str, root: str, key: str, buckets: int) -> DataFrame:
    """The rows of ``source`` (frame over files) that have a ``key``, in ``buckets`` buckets of it.

    Written under ``<root>/<name>`` unless a copy of this very version is there; older copies are deleted
    once the new one is complete.  Rows without a key can't join: they are left out, and make no hot bucket.
    """
    spark = source.sparkSession
    mark = version(source, key, buckets, source.columns)
    folder = f"{root.rstrip('/')}/{name}"
    path, table = f"{folder}/{mark}", f"{NAMESPACE}.{name}_{mark}"
    fs, make = _files(spark, folder)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {NAMESPACE}")
    if not fs.exists(make(f"{path}/_SUCCESS")):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        fs.delete(make(path), True)
        (source.where(source[key].isNotNull()).repartition(buckets, key)
         .write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table))
        for old in fs.listStatus(make(folder)):
            if old.getPath().getName() != mark:
                spark.sql(f"DROP TABLE IF EXISTS {NAMESPACE}.{name}_{old.getPath().getName()}")
                fs.delete(old.getPath(), True)
    elif not spark.catalog.tableExists(table):
        _register(spark, source, table, path, key, buckets)
    return spark.table(table)


def _register(spark: SparkSession, source: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
