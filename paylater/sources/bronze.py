"""Bronze layer B4-B8: lineage columns, full-refresh loads, load report.

A bronze table is its source rows plus ``_etl_extracted_at`` (run stamp)
and ``_etl_source`` (``postgres.<table>`` or ``file.user_events``).
Loads replace the target; a failed table does not stop the others, but the
failures are raised together at the end instead of being hidden.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paylater import schemas
from paylater.context import RunContext

# Lineage source names.
DATABASE_SOURCE = "postgres.{table}"
EVENTS_FILE_SOURCE = "file.user_events"
FILE_TABLES = {"user_events"}


def source_label(table: str) -> str:
    return EVENTS_FILE_SOURCE if table in FILE_TABLES else DATABASE_SOURCE.format(table=table)


def add_lineage(df: DataFrame, table: str, ctx: RunContext) -> DataFrame:
    """Append the two lineage columns."""
    return df.withColumns({
        schemas.ETL_EXTRACTED_AT: ctx.extracted_at_col,
        schemas.ETL_SOURCE: F.lit(source_label(table)),
    })


def bronze_frames(sources: dict[str, DataFrame], ctx: RunContext) -> dict[str, DataFrame]:
    """Lazy bronze tables from lazy source frames (nothing is written)."""
    return {t: add_lineage(df.select(*schemas.SOURCE_SCHEMAS[t].fieldNames()), t, ctx)
            for t, df in sources.items()}


def ensure_namespace(spark: SparkSession, name: str = "bronze") -> None:
    """The schema namespace (a catalog database)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def register_tables(spark: SparkSession, namespace: str, paths: dict[str, str]) -> list[str]:
    """Expose written Parquet folders as ``namespace.table`` in the catalog.

    The tables are external (the files stay where the load wrote them), so
    re-registering after a full refresh only replaces catalog entries.
    """
    ensure_namespace(spark, namespace)
    names = []
    for table, path in paths.items():
        name = f"`{namespace}`.`{table}`"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
        if any(c.isPartition for c in spark.catalog.listColumns(f"{namespace}.{table}")):
            spark.catalog.recoverPartitions(name)
        names.append(f"{namespace}.{table}")
    return names


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and a function that makes path objects."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _move(fs, source, target) -> None:
    """A rename that raises where Hadoop's only returns false."""
    if not fs.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def fresh_folder(path: str) -> str:
    """Where the next version of a table is written before it is published."""
    return f"{path.rstrip('/')}.new"


def publish_folder(spark: SparkSession, path: str) -> None:
    """Puts ``fresh_folder(path)`` in place of ``path``.

    The old version is moved aside, and deleted only after the new one is in place.  If the
    switch fails the old version is moved back; if the driver dies between the two renames
    it lies in ``<path>.old``, from where ``restore_folder`` brings it back.
    """
    fs, make = _files(spark, path)
    at, fresh, old = make(path), make(fresh_folder(path)), make(f"{path.rstrip('/')}.old")
    held = fs.exists(at)
    if held:
        fs.delete(old, True)
        _move(fs, at, old)
    try:
        _move(fs, fresh, at)
    except Exception:
        if held and not fs.exists(at):
            _move(fs, old, at)
        raise
    fs.delete(old, True)


def restore_folder(spark: SparkSession, path: str) -> None:
    """Brings back a version that a broken-off switch has left aside."""
    fs, make = _files(spark, path)
    at, old = make(path), make(f"{path.rstrip('/')}.old")
    if not fs.exists(at) and fs.exists(old):
        _move(fs, old, at)


def replace_folder(df: DataFrame, path: str) -> None:
    """Write ``df`` beside ``path``, and publish it when the write has ended."""
    restore_folder(df.sparkSession, path)
    df.write.mode("overwrite").parquet(fresh_folder(path))
    publish_folder(df.sparkSession, path)


def load_table(df: DataFrame, path: str, table: str, counts: dict[str, dict] | None = None) -> DataFrame:
    """Full refresh of one bronze table; returns the written table, re-read.

    Columns are written by name in the declared order (not by position).  The
    new load is written beside the old one and takes its place only when
    it is complete, so a load that fails leaves the old table as it was.
    ``counts`` receives the table's ``rows`` and its NULLs by column, counted by the write itself.
    """
    cols = schemas.SOURCE_SCHEMAS[table].fieldNames() + [schemas.ETL_EXTRACTED_AT, schemas.ETL_SOURCE]
    out = df.select(*cols)
    seen = Observation()
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    replace_folder(out.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls) if counts is not None else out, path)
    if counts is not None:
        counts[table] = seen.get
    # the schema is known: reading it back needs no footer-inference job
    return df.sparkSession.read.schema(out.schema).parquet(path)


def observed_row_counts(spark: SparkSession, counts: dict[str, dict]) -> DataFrame:
    """B6 from the counts that the loads have taken: no table is read again."""
    rows = [(source_label(t), int(c["rows"])) for t, c in counts.items() if c["rows"]]
    return spark.createDataFrame(rows, f"{schemas.ETL_SOURCE} string, row_count bigint")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table ``(_etl_source, row_count)``, computed by Spark.

    Each count is a distributed aggregate; the union has one row per table.
    """
    parts = [df.groupBy(schemas.ETL_SOURCE).agg(F.count(F.lit(1)).alias("row_count"))
             for df in tables.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class LoadReport:
    loaded: dict[str, str] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)


class BronzeLoadError(RuntimeError):
    def __init__(self, report: LoadReport):
        self.report = report
        super().__init__(f"bronze load failed for {sorted(report.failed)}: {report.failed}")
