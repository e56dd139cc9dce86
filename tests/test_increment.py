"""Incremental refresh, publication, repeated loads, compaction, and the other ingest paths that must lose nothing."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from paylater import jobs, schemas
from paylater.context import RunContext, shared_dir
from paylater.operators import quality
from paylater.plans import increment, metrics, warehouse
from paylater.sources import bronze, fixtures, readers
from paylater.streaming import events as event_stream
from tests.conftest import SF_SMALL, ts

STAMPS = ["dbt_updated_at", "source_extracted_at"]


@pytest.fixture(scope="module")
def sources(spark):
    """Six weeks of the source tables, one row for each key."""
    base = shared_dir(spark, "t-inc-src")
    out = {}
    for table, df in fixtures.source_tables(spark, SF_SMALL).items():
        key = increment.KEYS[table]
        time = increment.TIMES.get(table)
        if time and table != "user_events":
            df = df.where(F.col(time).isNull() | F.col(time).between(
                F.to_timestamp_ntz(F.lit("2001-03-01")), F.to_timestamp_ntz(F.lit("2001-04-12"))))
        columns = schemas.SOURCE_SCHEMAS[table].fieldNames()
        df = (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*columns)).alias("r")).select("r.*"))
        df.write.parquet(f"{base}/{table}")
        out[table] = spark.read.parquet(f"{base}/{table}")
    return out


def part(sources, upto):
    """A third, two thirds or all of the rows of every table."""
    return {t: df.where(F.pmod(F.xxhash64(increment.KEYS[t]), F.lit(3)) < upto) for t, df in sources.items()}


def table_rows(spark, path):
    name = path.rpartition("/")[2]
    df = spark.read.schema(warehouse.table_schemas(spark, stamp(1))[name]).parquet(path)
    df = df.drop(*[c for c in STAMPS if c in df.columns])
    df = df.select(*[F.to_json(F.struct(c)).alias(c) if "array" in t else F.col(c).cast("string").alias(c)
                     for c, t in sorted(df.dtypes)])
    return sorted((tuple(r) for r in df.collect()), key=str)


def stamp(day):
    return RunContext(as_of=dt.date(2001, 4, day), calendar_start=dt.date(2000, 1, 1))


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


@pytest.fixture(scope="module")
def grown(spark, sources):
    """A warehouse of two increments, and one of a full refresh."""
    one, two = shared_dir(spark, "t-inc"), shared_dir(spark, "t-full")
    jobs.refresh(spark, part(sources, 1), one, stamp(1))
    added = [increment.increment(spark, part(sources, k), one, stamp(10 * k - 8)) for k in (2, 3)]
    jobs.refresh(spark, sources, two, stamp(22))
    return one, two, added


@pytest.mark.parametrize("table", [f"silver/{t}" for t in warehouse.SILVER_TABLES]
                         + [f"gold/{t}" for t in warehouse.GOLD_TABLES])
def test_two_increments_equal_a_full_refresh(spark, grown, table):
    one, two, added = grown
    assert all(n > 0 for step in added for n in step.values())
    rows = table_rows(spark, f"{one}/{table}")
    assert rows and rows == table_rows(spark, f"{two}/{table}")


def test_untouched_days_keep_their_files_and_a_broken_run_is_finished(spark, sources, grown, monkeypatch):
    one, two, _ = grown
    day = dt.date(2001, 3, 20)
    old = sources["transactions"].where("customer_id is not null and merchant_id is not null").first()
    row = ("T-new", old.customer_id, old.merchant_id, ts("2001-03-20 11:00:00"), 12.5, "AED", "debit_card", "completed")
    more = dict(sources, transactions=sources["transactions"].unionByName(
        spark.createDataFrame([row], schemas.TRANSACTIONS)))
    folders = {t: files(f"{one}/silver/{t}") for t in warehouse.FACT_DATES}
    # the run breaks off after silver; the next one finishes it, though the source has no news then
    with monkeypatch.context() as m:
        m.setattr(increment, "update_gold", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            increment.increment(spark, more, one, stamp(22))
    again = increment.increment(spark, more, one, stamp(22))
    assert not any(again.values())
    jobs.refresh(spark, more, two, stamp(22))
    for t in ("fact_transactions", "dim_dates"):
        assert table_rows(spark, f"{one}/silver/{t}") == table_rows(spark, f"{two}/silver/{t}")
    for t in warehouse.GOLD_TABLES:
        assert table_rows(spark, f"{one}/gold/{t}") == table_rows(spark, f"{two}/gold/{t}")
    for t, before in folders.items():
        changed = before ^ files(f"{one}/silver/{t}")
        assert {f.split("_key=")[1][:10] for f in changed} == ({str(day)} if t == "fact_transactions" else set())


def test_failed_mart_leaves_all_published_ones(spark, sources, grown, monkeypatch):
    one, _, _ = grown
    before = {t: files(f"{one}/gold/{t}") for t in warehouse.GOLD_TABLES}
    silver = warehouse.read_silver(spark, one, stamp(22))
    marts = warehouse.gold_marts(silver, stamp(22))

    def broken():
        df = marts["gold_merchant_analytics"]()
        return df.withColumn("status", F.raise_error(F.lit("lost")).cast("string"))

    monkeypatch.setattr(warehouse, "gold_marts", lambda *a: {**marts, "gold_merchant_analytics": broken})
    with pytest.raises(warehouse.ParallelJobsError):
        warehouse.build_gold(spark, silver, one, stamp(22))
    assert {t: files(f"{one}/gold/{t}") for t in warehouse.GOLD_TABLES} == before
    assert spark.read.parquet(f"{one}/gold/gold_merchant_analytics").count() > 0


def test_a_refused_rename_brings_the_old_version_back(spark, monkeypatch):
    path = shared_dir(spark, "t-switch") + "/t"
    bronze.replace_folder(spark.range(3), path)
    spark.range(9).write.parquet(bronze.fresh_folder(path))
    moves = []

    def refuse(fs, source, target):
        moves.append(str(source))
        if len(moves) == 2:
            raise OSError("refused")
        assert fs.rename(source, target)

    with monkeypatch.context() as m:
        m.setattr(bronze, "_move", refuse)
        with pytest.raises(OSError):
            bronze.publish_folder(spark, path)
    assert spark.read.parquet(path).count() == 3 and len(moves) == 3
    # a driver that dies between the two renames leaves the old version aside
    os.rename(path, path + ".old")
    bronze.restore_folder(spark, path)
    assert spark.read.parquet(path).count() == 3
    fs, make = bronze._files(spark, path)
    with pytest.raises(Exception):
        bronze._move(fs, make(path + ".nothing"), make(path + ".target"))


def test_rows_without_keys_and_copies_load_once(spark, ctx):
    target = shared_dir(spark, "t-null-keys")
    kind = schemas.CUSTOMERS

    def customer(i, name):
        return (i, name, *[None] * 8)

    rows = [customer(None, f"n{i}") for i in range(10)] + [customer("C1", "b"), customer("C1", "a"), customer("C2", "x")]
    rows += [customer(None, "n3")]
    empty = bronze.add_lineage(spark.createDataFrame([], kind), "customers", ctx)
    empty.write.parquet(f"{target}/bronze/customers")
    incoming = {"customers": spark.createDataFrame(rows, kind)}
    assert jobs.append_new(spark, incoming, target, ctx) == {"customers": 12}
    assert jobs.append_new(spark, incoming, target, ctx) == {"customers": 0}
    held = spark.read.parquet(f"{target}/bronze/customers")
    assert held.where("customer_id = 'C1'").first().email == "a" and held.count() == 12
    other = {"customers": spark.createDataFrame([customer(None, "new"), customer("C1", "c")], kind)}
    assert jobs.append_new(spark, other, target, ctx) == {"customers": 1}


def _events(spark, rows):
    return spark.createDataFrame(
        [(i, None if when is None else ts(when), "C1", "search", "ios", None, "s", "mobile", "UAE") for i, when in rows],
        schemas.USER_EVENTS)


def test_event_stream_keeps_events_without_id(spark, ctx):
    base = shared_dir(spark, "t-null-ids")
    rows = [(f"e{i}", f"2024-01-{1 + i % 5:02d} 00:00:00") for i in range(990)]
    rows += [(None, f"2024-01-{1 + i % 5:02d} 00:00:00") for i in range(8)] + [(None, None)] * 2
    readers.write_csv(_events(spark, rows), f"{base}/in/one")
    for _ in range(2):
        event_stream.ingest_event_files(spark, f"{base}/in/*", f"{base}/out", f"{base}/ck", ctx)
    got = event_stream.read_events(spark, f"{base}/out")
    assert got.count() == 1000 and got.where("event_id is null").count() == 10
    # a batch that is run again writes the same rows to the same folders
    raw = _events(spark, rows).withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    event_stream.load_batch(raw, 0, f"{base}/out", ctx)
    assert event_stream.read_events(spark, f"{base}/out").count() == 1000


def test_event_lookup_reads_the_days_of_the_batch_only(spark, ctx):
    base = shared_dir(spark, "t-days")
    raw = lambda rows: _events(spark, rows).withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    event_stream.load_batch(raw([(f"e{i}", f"2024-01-{1 + i:02d} 00:00:00") for i in range(20)]), 0, base, ctx)
    held = event_stream.read_events(spark, base)
    ids = event_stream.held_ids(held, [dt.date(2024, 1, 3)], 1)
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(event_day" in plan or "PartitionFilters: [isnotnull(event_day" in plan
    assert "PushedFilters: []" in plan and [r.event_id for r in ids.collect()] == ["e2"]


def test_compaction_keeps_rows_and_finishes_what_broke_off(spark, ctx, monkeypatch):
    base = shared_dir(spark, "t-compact")
    raw = lambda rows: _events(spark, rows).withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    for batch in range(6):
        rows = [(f"e{batch}-{i}", f"2024-01-{1 + i % 3:02d} 00:00:00") for i in range(6)] + [(None, None)]
        event_stream.load_batch(raw(rows), batch, base, ctx)
    ids = lambda: sorted(str(r.event_id) for r in event_stream.read_events(spark, base).collect())
    before = ids()
    assert len(before) == 42 and event_stream.compact(spark, base, 5, least=9) == 0
    moved = []

    def breaks(fs, source, target):
        moved.append(target)
        if len(moved) == 2:
            raise OSError("lost driver")
        assert fs.rename(source, target)

    with monkeypatch.context() as m:
        m.setattr(event_stream, "_move", breaks)
        with pytest.raises(OSError):
            event_stream.compact(spark, base, 5, least=3)
    assert event_stream.compact(spark, base, 5, least=3) == 3
    assert ids() == before
    batches = {r.load_batch for r in event_stream.read_events(spark, base).select("load_batch").distinct().collect()}
    assert batches == {4, 5}
    # the newest batch may still be repeated, and its rows are not loaded again by a later one
    event_stream.load_batch(raw(rows), 5, base, ctx)
    event_stream.load_batch(raw([("e0-0", "2024-01-01 00:00:00"), ("late", "2024-01-01 00:00:00")]), 6, base, ctx)
    assert ids() == sorted([*before, "late"])


def test_quantiles_of_any_spread_are_exact_in_bounded_windows(spark):
    import numpy as np
    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.lit("hot")).cast("string").alias("g"),
        F.when(F.col("id") == 1, F.lit(1e12)).when(F.col("id") == 2, F.lit(-1e300))
        .when(F.col("id") % 7 == 0, -F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1e9)
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(90_000_000)) / 100).alias("v"))
    shares = [0.25, 0.5, 0.75, 1.0]
    got = {r.g: (r.q0, r.q1, r.q2, r.q3) for r in quality.exact_quantiles(df, "g", "v", shares).collect()}
    table = df.toPandas()
    for g, rows in table.groupby(table.g.fillna("-")):
        v = np.sort(rows.v.to_numpy())
        assert got[None if g == "-" else g] == tuple(v[max(1, int(np.ceil(p * len(v)))) - 1] for p in shares)
    # the bits keep the order of the values, so a window holds at most one row for each digit
    values = [-1e300, -2.5, -1e-300, 0.0, 5e-324, 1.0, 1.5, 1e12, float("inf")]
    bits = [r.b % 2 ** 64 for r in spark.createDataFrame([(v,) for v in values], "v double")
            .select(quality.sortable_bits("v").alias("b")).collect()]
    assert bits == sorted(bits) and len(set(bits)) == len(bits)


def test_cut_points_give_near_equal_ranges(spark):
    df = spark.range(20_000).select(F.concat(F.lit("T"), F.col("id") * F.col("id")).alias("transaction_id"))
    cuts = readers.cut_points(df, "transaction_id", 8)
    counts = [df.where(p).count() for p in readers.range_predicates("transaction_id", cuts)]
    assert len(counts) == 8 and sum(counts) == 20_000 and max(counts) < 1.5 * 2500 and min(counts) > 0.5 * 2500
    assert readers.cut_points(df.limit(0), "transaction_id", 8) == []


def test_database_tables_are_cut_by_the_last_load(spark, grown, monkeypatch):
    asked = {}
    monkeypatch.setattr(readers, "read_jdbc", lambda spark, url, table, *, predicates, properties:
                        asked.setdefault(table, predicates))
    jobs.read_database(spark, "jdbc:none", grown[0], 4)
    assert {len(p) for t, p in asked.items() if t in ("transactions", "user_events")} == {4}
    first = {}
    monkeypatch.setattr(readers, "read_jdbc", lambda spark, url, table, *, predicates, properties:
                        first.setdefault(table, predicates))
    jobs.read_database(spark, "jdbc:none", shared_dir(spark, "t-no-load"), 4)
    assert set(map(tuple, first.values())) == {("1 = 1",)} and set(first) == set(schemas.SOURCE_SCHEMAS)


def test_date_bounds_from_folder_names(spark, grown):
    path = f"{grown[0]}/silver/fact_transactions"
    stored = metrics.stored_date_bounds(spark, path)
    assert stored.collect() == metrics.date_bounds(spark.read.parquet(path)).collect()
    assert "Parquet" not in stored._jdf.queryExecution().executedPlan().toString()
    os.makedirs(f"{path}-none")
    assert tuple(metrics.stored_date_bounds(spark, f"{path}-none").first()) == (None, None)


def test_every_declared_test_finds_its_flaw(spark):
    """A violation for each unique and not_null test, counted by the one-scan report as by the single checks."""
    tables = {}
    for table, schema in schemas.SOURCE_SCHEMAS.items():
        base = spark.createDataFrame([(0,), (1,), (1,), (2,)], "n int")
        columns = []
        for f in schema.fields:
            value = (F.concat(F.lit(f"{f.name}-"), F.col("n")) if f.dataType.simpleString() == "string"
                     else F.to_timestamp_ntz(F.lit("2001-01-01")) if "timestamp" in f.dataType.simpleString()
                     else F.lit(1).cast(f.dataType))
            columns.append(F.when(F.col("n") < 2, value).alias(f.name))      # the last row is all NULL
        tables[table] = base.select(*columns)
    report = {(r.table, r.column, r.test): r.failures for r in quality.dq_report(tables).collect()}
    assert len(report) == 33
    assert all(n == 1 for (_, _, test), n in report.items() if test in ("unique", "not_null"))
    single = (quality.unique_report(tables).unionByName(quality.not_null_report(tables))
              .unionByName(quality.relationships_report(tables)))
    assert {(r.table, r.column, r.test): r.failures for r in single.collect()} == report
    text = quality.dq_report(tables)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Generate explode") == 6            # one for each table
