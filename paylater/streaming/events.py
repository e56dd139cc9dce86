"""Incremental ingest of user-event files (X2) with Structured Streaming.

New CSV files in a folder are read once each (the checkpoint records which
files were committed).  Each micro-batch keeps one copy of an ``event_id``,
leaves out the ids that the sink holds already, and writes the rest, with lineage columns, to
folders by event day and batch: a repeated batch replaces its own.  Only the folders of
the batch's days are read for the ids.  Events without an id have nothing to be
compared by: each line of a file is one.  No row is late: how old an event is does not matter.
``compact`` merges the folders that old batches have left for a day.
``availableNow`` processes what is there and stops, so the same job
runs as a scheduled batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylater import schemas
from paylater.context import RunContext
from paylater.operators.incremental import new_by_key
from paylater.sources.bronze import _files, _move, add_lineage

BATCH = "load_batch"
DAY = "event_day"


def file_schema() -> T.StructType:
    """User-event CSV columns, with the timestamp as text."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.name == "event_timestamp" else f.dataType, True)
        for f in schemas.USER_EVENTS.fields
    ])


def event_file_stream(spark: SparkSession, source_dir: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(file_schema()).option("header", True)
              .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source_dir)


def typed_events(rows: DataFrame, ctx: RunContext) -> DataFrame:
    """Bronze ``user_events`` columns from the files' text."""
    typed = rows.select(*[F.to_timestamp_ntz(F.col(n)).alias(n) if n == "event_timestamp" else F.col(n)
                          for n in schemas.USER_EVENTS.fieldNames()])
    return add_lineage(typed, "user_events", ctx)


def bronze_schema() -> T.StructType:
    """Columns of the ingested table: the source columns plus lineage."""
    return T.StructType(schemas.USER_EVENTS.fields + [
        T.StructField(schemas.ETL_EXTRACTED_AT, T.TimestampNTZType(), True),
        T.StructField(schemas.ETL_SOURCE, T.StringType(), True)])


def read_events(spark: SparkSession, sink_dir: str) -> DataFrame | None:
    """The ingested table, with the day and the number of the batch of each row; None before the first load."""
    schema = bronze_schema().add(DAY, T.DateType()).add(BATCH, T.LongType())
    try:
        return spark.read.schema(schema).parquet(sink_dir)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def held_ids(held: DataFrame, days: list[dt.date | None], batch: int) -> DataFrame:
    """``event_id`` of the rows that batches other than ``batch`` have loaded for some days."""
    wanted = F.col(DAY).isin([d for d in days if d is not None])
    if None in days:
        wanted = wanted | F.col(DAY).isNull()
    return held.where(wanted & (F.col(BATCH) != batch)).select("event_id")


def load_batch(rows: DataFrame, batch: int, sink_dir: str, ctx: RunContext) -> None:
    """Write the events of one micro-batch that the sink lacks.

    An event keeps its day, so its id can only be among the ids of that day.
    """
    spark = rows.sparkSession
    typed = typed_events(rows, ctx)
    known = F.col("event_id").isNotNull()
    # of copies of one event the smallest row, so that a repeated batch writes the same rows
    once = (typed.where(known).groupBy("event_id")
            .agg(F.min(F.struct(*[c for c in typed.columns if c != "event_id"])).alias("_row"))
            .select("event_id", "_row.*").select(*typed.columns))
    fresh = once.unionByName(typed.where(~known)).withColumn(DAY, F.col("event_timestamp").cast("date"))
    held = read_events(spark, sink_dir)
    if held is not None:
        days = [r[0] for r in fresh.select(DAY).distinct().collect()]        # as many as the batch has days
        fresh = new_by_key(fresh, held_ids(held, days, batch), ["event_id"]).select(*fresh.columns)
    (fresh.withColumn(BATCH, F.lit(batch).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(sink_dir))


READY = "_READY"


def compact(spark: SparkSession, sink_dir: str, before: int, least: int = 8) -> int:
    """Merges, for each day with ``least`` batch folders or more, those of batches under ``before`` into one.

    ``before`` is the newest batch: only that one can be repeated, so its folder stays as it is.  The merged rows are
    written beside the table and marked complete before any folder is moved; a compaction that broke off after
    that is finished by the next one, so no row is lost or doubled.  No load may run meanwhile.
    Returns the number of days that were merged.
    """
    fs, make = _files(spark, sink_dir)
    root = sink_dir.rstrip("/")
    staged = f"{root}/_compact"
    if not fs.exists(make(f"{staged}/{READY}")):
        fs.delete(make(staged), True)
        days = {}
        for day in fs.listStatus(make(root)):
            name = day.getPath().getName()
            if name.startswith(f"{DAY}="):
                batches = [b.getPath().getName() for b in fs.listStatus(day.getPath())]
                old = [int(b.partition("=")[2]) for b in batches if b.startswith(f"{BATCH}=")]
                days[name] = [n for n in old if n < before]
        days = {name: old for name, old in days.items() if len(old) >= least}
        if not days:
            return 0
        held = read_events(spark, sink_dir)
        asked = spark.createDataFrame([(None if d.endswith("__HIVE_DEFAULT_PARTITION__") else
                                        dt.date.fromisoformat(d.partition("=")[2]), max(old))
                                       for d, old in days.items()], "_day date, _into bigint")
        merged = (held.where(F.col(BATCH) < before).join(F.broadcast(asked), F.col(DAY).eqNullSafe(F.col("_day")))
                  .select(*bronze_schema().fieldNames(), DAY, F.col("_into").alias(BATCH)))
        merged.hint("rebalance", DAY).write.partitionBy(DAY, BATCH).parquet(staged)
        fs.create(make(f"{staged}/{READY}")).close()
    done = 0
    for day in fs.listStatus(make(staged)):
        name = day.getPath().getName()
        if not name.startswith(f"{DAY}="):
            continue
        into = [b.getPath() for b in fs.listStatus(day.getPath()) if b.getPath().getName().startswith(f"{BATCH}=")]
        for folder in into:                     # one; none where a broken-off run has moved it already
            upto = int(folder.getName().partition("=")[2])
            for b in fs.listStatus(make(f"{root}/{name}")):
                number = b.getPath().getName().partition("=")[2]
                if number.isdigit() and int(number) <= upto:
                    fs.delete(b.getPath(), True)
            _move(fs, folder, make(f"{root}/{name}/{folder.getName()}"))
            done += 1
    fs.delete(make(staged), True)
    return done


def ingest_event_files(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                       ctx: RunContext, max_files_per_trigger: int | None = None) -> None:
    """Process every file not yet committed, append to ``sink_dir``, and stop."""
    q = (event_file_stream(spark, source_dir, max_files_per_trigger).writeStream
         .foreachBatch(lambda rows, batch: load_batch(rows, batch, sink_dir, ctx))
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"event ingest failed: {q.exception()}")
