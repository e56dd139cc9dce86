"""Full refresh of the warehouse as one batch job.

    python -m paylater.jobs --target DIR (--sources DIR [--format csv|parquet|jdbc]
                                          | --test-tables SF_DIR | --rebuild)
                            [--as-of YYYY-MM-DD] [--calendar-start YYYY-MM-DD]
                            [--shuffle-partitions N] [--no-partition-by-day] [--register] [--strict]
                            [--incremental] [--join-buckets N]

Reads the six source tables (one folder each under ``--sources``, or the
mapping over the driver's test tables), loads bronze, builds silver and
gold under ``--target``, writes the data-quality report and the load
report, and fails if any declared test has failures when ``--strict``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from paylater import schemas
from paylater.context import DEFAULT_CALENDAR_START, RunContext, build_session
from paylater.operators import quality
from paylater.plans import warehouse
from paylater.plans.increment import KEYS, append_new, increment
from paylater.sources import bronze, fixtures, readers


def read_database(spark: SparkSession, url: str, target: str, ranges: int,
                  properties: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The source tables of a database, each by as many concurrent reads as ``ranges``.

    The cuts come from the keys of the last bronze load under ``target``; the first load reads each table at once.
    """
    out = {}
    for table in schemas.SOURCE_SCHEMAS:
        try:
            held = spark.read.parquet(f"{target.rstrip('/')}/bronze/{table}")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            cuts = []
        else:
            cuts = readers.cut_points(held, KEYS[table], ranges)
        out[table] = readers.read_jdbc(spark, url, table, properties=properties,
                                       predicates=readers.range_predicates(KEYS[table], cuts))
    return out


def read_sources(spark: SparkSession, sources: str, fmt: str) -> dict[str, DataFrame]:
    out = {}
    for table, schema in schemas.SOURCE_SCHEMAS.items():
        path = f"{sources.rstrip('/')}/{table}"
        if fmt == "csv":
            out[table] = readers.read_csv(spark, path, table)
        else:
            out[table] = spark.read.schema(schema).parquet(path)
    return out


def refresh(spark: SparkSession, sources: dict[str, DataFrame], target: str, ctx: RunContext,
            parallel_jobs: int = 4, register: bool = False,
            partition_by_day: bool = True, join_buckets: int | None = None) -> dict:
    """bronze -> silver -> gold, then the DQ and load reports; returns a summary.

    With ``register``, the written tables are exposed in the catalog as
    ``bronze.*``, ``silver.*``, ``gold.*`` and ``reports.*``.
    """
    stg, silver = warehouse.build_warehouse(spark, bronze.bronze_frames(sources, ctx), target, ctx,
                                            parallel_jobs, partition_by_day, join_buckets)
    gold = warehouse.build_gold(spark, silver, target, ctx, parallel_jobs)
    root = target.rstrip("/")
    bronze.replace_folder(quality.dq_report(stg), f"{root}/reports/dq_report")
    bronze.replace_folder(bronze.observed_row_counts(spark, silver.bronze_counts), f"{root}/reports/bronze_row_counts")
    dq = spark.read.parquet(f"{root}/reports/dq_report")
    failing = [f"{r['table']}.{r['column']}:{r['test']}={r['failures']}"
               for r in dq.where("failures > 0").collect()]      # at most 33 report rows
    summary = {"target": root, "gold": sorted(gold), "failing_tests": failing}
    if register:
        layers = {"bronze": list(sources), "silver": warehouse.SILVER_TABLES,
                  "gold": warehouse.GOLD_TABLES, "reports": ["dq_report", "bronze_row_counts"]}
        summary["tables"] = [n for layer, tables in layers.items()
                             for n in bronze.register_tables(
                                 spark, layer, {t: f"{root}/{layer}/{t}" for t in tables})]
    return summary


def rebuild(spark: SparkSession, target: str, ctx: RunContext, parallel_jobs: int = 4,
            partition_by_day: bool = True, join_buckets: int | None = None) -> dict:
    """silver and gold from the bronze tables under ``target``; no source is read.

    For a changed run date or mart, or after several increments.  With ``join_buckets`` the plans' transaction lookup
    reads the bucketed copies of the last build where bronze is still the same.
    """
    root = target.rstrip("/")
    _, silver = warehouse.build_silver(spark, warehouse.read_bronze(spark, root), root, ctx, parallel_jobs, partition_by_day,
                                       join_buckets)
    return {"target": root, "gold": sorted(warehouse.build_gold(spark, silver, root, ctx, parallel_jobs))}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--target", required=True)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--rebuild", action="store_true", help="silver and gold from bronze under the target")
    src.add_argument("--sources")
    src.add_argument("--test-tables")
    ap.add_argument("--format", choices=["csv", "parquet", "jdbc"], default="parquet",
                    help="with jdbc, --sources is the database's URL")
    ap.add_argument("--jdbc-ranges", type=int, default=16, help="concurrent reads of one table")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    ap.add_argument("--calendar-start", type=dt.date.fromisoformat, default=DEFAULT_CALENDAR_START,
                    help="first day of the calendar dimension")
    ap.add_argument("--strict", action="store_true")
    ap.add_argument("--register", action="store_true", help="expose layers as catalog tables")
    ap.add_argument("--no-partition-by-day", action="store_true",
                    help="write facts in one folder, not partitioned by their date key")
    ap.add_argument("--incremental", action="store_true",
                    help="load new rows into all layers under the target instead of a full refresh")
    ap.add_argument("--join-buckets", type=int, default=None,
                    help="keep plans and transaction ids in so many buckets of the transaction id")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="about total shuffle bytes / 128 MB; AQE coalesces down")
    args = ap.parse_args(argv)
    spark = build_session(shuffle_partitions=args.shuffle_partitions)
    ctx = RunContext(as_of=args.as_of, updated_at=dt.datetime.now().replace(microsecond=0),
                     extracted_at=dt.datetime.now().replace(microsecond=0),
                     calendar_start=args.calendar_start)
    if args.rebuild:
        print(json.dumps(rebuild(spark, args.target, ctx, partition_by_day=not args.no_partition_by_day,
                                 join_buckets=args.join_buckets)))
        return 0
    if args.sources and args.format == "jdbc":
        sources = read_database(spark, args.sources, args.target, args.jdbc_ranges)
    elif args.sources:
        sources = read_sources(spark, args.sources, args.format)
    else:
        sources = fixtures.source_tables(spark, args.test_tables)
    if args.incremental:
        print(json.dumps(increment(spark, sources, args.target, ctx)))
        return 0
    summary = refresh(spark, sources, args.target, ctx, register=args.register,
                      partition_by_day=not args.no_partition_by_day, join_buckets=args.join_buckets)
    print(json.dumps(summary))
    return 1 if (args.strict and summary["failing_tests"]) else 0


__all__ = ["refresh", "rebuild", "increment", "append_new", "read_sources", "read_database", "main"]


if __name__ == "__main__":
    raise SystemExit(main())
