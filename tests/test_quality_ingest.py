
import pytest
from pyspark.sql import functions as F

from paylater import schemas
from paylater.context import shared_dir
from paylater.operators import incremental, quality
from paylater.sources import bronze, readers
from paylater.streaming import events as event_stream
from tests.conftest import ts


def _empty(spark, table):
    return spark.createDataFrame([], schemas.SOURCE_SCHEMAS[table])


def _tables(spark):
    t = {name: _empty(spark, name) for name in schemas.SOURCE_SCHEMAS}
    t["customers"] = spark.createDataFrame(
        [("C1",) + (None,) * 9, ("C1",) + (None,) * 9, (None,) + (None,) * 9], schemas.CUSTOMERS)
    t["merchants"] = spark.createDataFrame([("M1",) + (None,) * 6], schemas.MERCHANTS)
    t["transactions"] = spark.createDataFrame(
        [("T1", "C1", "M1", ts("2001-01-01 00:00:00"), 1.0, "AED", "debit_card", "completed"),
         ("T2", "C9", "M9", None, -1.0, "USD", "cash", "completed"),
         ("T3", "C9", None, None, 2.0, "AED", "debit_card", "completed")], schemas.TRANSACTIONS)
    return t


def test_declared_tests_find_violations(spark):
    report = {(r.table, r.column, r.test): r.failures
              for r in quality.dq_report(_tables(spark)).collect()}
    assert len(report) == 33
    assert report[("customers", "customer_id", "unique")] == 1
    assert report[("customers", "customer_id", "not_null")] == 1
    assert report[("transactions", "merchant_id", "not_null")] == 1
    assert report[("transactions", "transaction_date", "not_null")] == 2
    assert report[("transactions", "customer_id", "relationships:customers.customer_id")] == 2
    assert report[("transactions", "merchant_id", "relationships:merchants.merchant_id")] == 1
    assert report[("installments", "plan_id", "relationships:payment_plans.plan_id")] == 0


def test_business_rules_and_installment_totals(spark):
    t = _tables(spark)
    t["payment_plans"] = spark.createDataFrame(
        [("P1", "T1", "C1", "M1", ts("2001-01-01 00:00:00"), 100.0, 3, 33.33, "active")], schemas.PAYMENT_PLANS)
    t["installments"] = spark.createDataFrame(
        [("I1", "P1", 1, 33.33, ts("2001-01-01 00:00:00"), None, "paid"),
         ("I2", "P1", 2, 33.33, ts("2001-02-01 00:00:00"), ts("2001-02-01 00:00:00"), "scheduled"),
         ("I3", "P1", 3, 30.00, ts("2001-03-01 00:00:00"), None, "scheduled")], schemas.INSTALLMENTS)
    rep = {(r.table, r.column, r.test): r.failures for r in quality.business_rules_report(t).collect()}
    assert rep[("transactions", "currency", "accepted_values")] == 1
    assert rep[("transactions", "payment_method", "accepted_values")] == 1
    assert rep[("transactions", "amount", "positive")] == 1
    assert rep[("installments", "paid_date", "set_iff_paid")] == 2
    assert rep[("installments", "amount", "sums_to_plan_total")] >= 1


def test_outliers_iqr_fence_hot_group(spark):
    rows = [("m1", f"t{i}", float(v)) for i, v in enumerate([10, 11, 12, 13, 14, 15, 16, 17, 100])]
    rows += [(None, "n1", 5.0), (None, "n2", 5.0)]
    df = spark.createDataFrame(rows, "merchant_sk string, transaction_id string, amount double")
    out = quality.outliers(df, "merchant_sk", "amount", "transaction_id").collect()
    assert [(r.transaction_id, r.q1, r.q3) for r in out] == [("t8", 12.0, 16.0)]


def test_incremental_new_rows(spark):
    tgt = spark.createDataFrame([("a", ts("2024-01-01 00:00:00")), ("b", ts("2024-01-02 00:00:00"))],
                                "event_id string, event_timestamp timestamp_ntz")
    inc = spark.createDataFrame([("b", ts("2024-01-02 00:00:00")), ("c", ts("2024-01-03 00:00:00")),
                                 (None, ts("2024-01-03 00:00:00"))],
                                "event_id string, event_timestamp timestamp_ntz")
    assert sorted((r.event_id or "-") for r in incremental.new_by_key(inc, tgt, ["event_id"]).collect()) == ["-", "c"]
    win = incremental.new_since(inc, tgt, ["event_id"], "event_timestamp")
    assert sorted((r.event_id or "-") for r in win.collect()) == ["-", "c"]


def test_csv_round_trip_and_bronze_load(spark, ctx):
    base = shared_dir(spark, "t-bronze")
    df = spark.createDataFrame(
        [("T1", "C1", None, ts("2001-01-01 10:11:12.123456"), 1.5, "AED", "debit_card", "completed")],
        schemas.TRANSACTIONS)
    readers.write_csv(df, f"{base}/csv")
    back = readers.read_csv(spark, f"{base}/csv", "transactions")
    assert back.collect() == df.collect()
    back3 = readers.read_csv_text_dates(spark, f"{base}/csv", "transactions")
    assert back3.collect() == df.collect()

    counts = {}
    bronze.load_table(bronze.add_lineage(df, "transactions", ctx), f"{base}/bronze/transactions", "transactions", counts)
    assert counts["transactions"]["rows"] == 1 and counts["transactions"]["merchant_id"] == 1
    assert [tuple(r) for r in bronze.observed_row_counts(spark, counts).collect()] == [("postgres.transactions", 1)]
    loaded = spark.read.parquet(f"{base}/bronze/transactions").first()
    assert loaded._etl_source == "postgres.transactions" and loaded._etl_extracted_at == ts("2001-08-02 00:00:00")


def test_event_stream_exactly_once_and_dedup(spark, ctx):
    base = shared_dir(spark, "t-stream")
    rows = [(f"e{i}", ts(f"2024-01-01 0{i}:00:00"), "C1", "search", "ios", None, "s", "mobile", "UAE")
            for i in range(4)]
    df = spark.createDataFrame(rows, schemas.USER_EVENTS)
    readers.write_csv(df.limit(3).unionAll(df.limit(1)), f"{base}/in/batch1")
    src, sink, ck = f"{base}/in/batch1", f"{base}/out", f"{base}/ck"
    event_stream.ingest_event_files(spark, src, sink, ck, ctx)
    first = spark.read.parquet(sink)
    assert first.count() == 3 and first.select("event_id").distinct().count() == 3
    event_stream.ingest_event_files(spark, src, sink, ck, ctx)       # nothing new
    assert spark.read.parquet(sink).count() == 3
    got = {r.event_id: r.event_timestamp for r in spark.read.parquet(sink).collect()}
    assert got["e1"] == ts("2024-01-01 01:00:00")


def test_full_refresh_job_on_smallest_tables(spark, ctx):
    from paylater import jobs
    from paylater.sources import fixtures
    from tests.conftest import SF_SMALL
    target = shared_dir(spark, "t-job")
    summary = jobs.refresh(spark, fixtures.source_tables(spark, SF_SMALL), target, ctx, register=True)
    assert summary["gold"] == ["gold_customer_analytics", "gold_merchant_analytics",
                               "gold_payment_analytics", "gold_transaction_analytics"]
    # the mapping leaves some transactions without a merchant on purpose
    assert any(t.startswith("transactions.merchant_id:not_null") for t in summary["failing_tests"])
    gc = spark.read.parquet(f"{target}/gold/gold_customer_analytics")
    dc = spark.read.parquet(f"{target}/silver/dim_customers")
    assert gc.count() == dc.count()
    counts = {r._etl_source: r.row_count for r in spark.read.parquet(f"{target}/reports/bronze_row_counts").collect()}
    assert counts["file.user_events"] == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert "silver.fact_transactions" in summary["tables"]
    n = spark.sql("SELECT count(*) AS n FROM silver.fact_transactions").first().n
    assert n == spark.sql("SELECT count(*) AS n FROM bronze.transactions").first().n
    assert spark.sql("SELECT count(*) AS n FROM reports.dq_report").first().n == 33


def test_warehouse_bronze_phase_reports_every_failed_table(spark, ctx):
    from paylater.plans import warehouse
    from paylater.sources import fixtures
    from tests.conftest import SF_SMALL
    srcs = fixtures.source_tables(spark, SF_SMALL)
    bronze_tables = bronze.bronze_frames(srcs, ctx)
    # two sources that fail when the load job runs (as a dropped connection would)
    for table in ["merchants", "user_events"]:
        cols = [F.raise_error(F.lit(f"{table} source down")).cast(f.dataType).alias(f.name)
                if i == 0 else F.lit(None).cast(f.dataType).alias(f.name)
                for i, f in enumerate(schemas.SOURCE_SCHEMAS[table].fields)]
        bronze_tables[table] = bronze.add_lineage(spark.range(1).select(*cols), table, ctx)
    with pytest.raises(bronze.BronzeLoadError) as err:
        warehouse.build_warehouse(spark, bronze_tables, shared_dir(spark, "t-fail"), ctx)
    assert set(err.value.report.failed) == {"merchants", "user_events"}
    assert set(err.value.report.loaded) == {"customers", "transactions", "payment_plans", "installments"}


def test_event_stream_second_delivery_appends_only_new_events(spark, ctx):
    base = shared_dir(spark, "t-stream2")
    src, sink, ck = f"{base}/in", f"{base}/out", f"{base}/ck"

    def events(ids, hour):
        return spark.createDataFrame(
            [(i, ts(f"2024-01-02 {hour:02d}:00:00"), "C1", "search", "ios", None, "s", "mobile", "UAE")
             for i in ids], schemas.USER_EVENTS)

    readers.write_csv(events(["a", "b"], 1), f"{src}/batch1")
    event_stream.ingest_event_files(spark, f"{src}/*", sink, ck, ctx)
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == ["a", "b"]
    # a later file re-delivers "b" and brings a new event "c" within the watermark
    readers.write_csv(events(["b", "c"], 2), f"{src}/batch2")
    event_stream.ingest_event_files(spark, f"{src}/*", sink, ck, ctx)
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def test_incremental_append_twice_adds_nothing_the_second_time(spark):
    target = shared_dir(spark, "t-incr") + "/events"
    first = spark.createDataFrame([("a", ts("2024-01-01 00:00:00"))], "event_id string, event_timestamp timestamp_ntz")
    first.write.parquet(target)
    incoming = spark.createDataFrame([("a", ts("2024-01-01 00:00:00")), ("b", ts("2024-01-02 00:00:00"))],
                                     "event_id string, event_timestamp timestamp_ntz")
    for _ in range(2):
        new = incremental.new_since(incoming, spark.read.parquet(target), ["event_id"], "event_timestamp")
        incremental.append(new, target)
    assert sorted(r.event_id for r in spark.read.parquet(target).collect()) == ["a", "b"]


def test_job_command_line(spark, capsys):
    import json
    from paylater import jobs
    from tests.conftest import SF_SMALL
    target = shared_dir(spark, "t-cli")
    code = jobs.main(["--test-tables", SF_SMALL, "--target", target, "--as-of", "2001-08-02",
                      "--calendar-start", "2000-01-01"])
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and summary["target"] == target and len(summary["gold"]) == 4
    # --strict fails the run when a declared test has failures (the test tables have some)
    assert jobs.main(["--test-tables", SF_SMALL, "--target", target + "-2", "--as-of", "2001-08-02",
                      "--strict"]) == 1
    days = spark.read.parquet(f"{target}/silver/fact_transactions").select("transaction_date_key").distinct()
    assert days.count() > 300


def test_late_and_future_rows_load(spark):
    day = lambda d: ts(f"2024-01-{d:02d} 00:00:00")
    kind = "event_id string, event_timestamp timestamp_ntz"
    held = spark.createDataFrame([("a", day(9)), ("b", day(10)), ("f", ts("2031-01-01 00:00:00"))], kind)
    incoming = spark.createDataFrame([("late", day(1)), ("b", day(10)), ("c", day(11)), ("n", None)], kind)
    new = incremental.new_since(incoming, held, ["event_id"], "event_timestamp")
    assert sorted(r.event_id for r in new.collect()) == ["c", "late", "n"]
    assert incremental.new_since(incoming.where("event_id = 'x'"), held, ["event_id"], "event_timestamp").count() == 0
    assert incremental.new_since(incoming, held.where("event_id = 'x'"), ["event_id"], "event_timestamp").count() == 4


def test_event_stream_loads_late_files_and_repeats_batches(spark, ctx):
    base = shared_dir(spark, "t-late")
    src, sink, ck = f"{base}/in", f"{base}/out", f"{base}/ck"

    def events(ids, month):
        return spark.createDataFrame(
            [(i, ts(f"2024-{month:02d}-02 00:00:00"), "C1", "search", "ios", None, "s", "mobile", "UAE")
             for i in ids], schemas.USER_EVENTS)

    readers.write_csv(events(["new1", "new2", "new1"], 6), f"{src}/batch1")
    event_stream.ingest_event_files(spark, f"{src}/*", sink, ck, ctx)
    readers.write_csv(events(["old1", "old2"], 1).unionAll(events(["new2"], 6)), f"{src}/batch2")
    event_stream.ingest_event_files(spark, f"{src}/*", sink, ck, ctx)
    ids = lambda: sorted(r.event_id for r in event_stream.read_events(spark, sink).collect())
    assert ids() == ["new1", "new2", "old1", "old2"]
    # a batch that is run again replaces what it wrote
    raw = events(["old1", "old2"], 1).withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    event_stream.load_batch(raw, 1, sink, ctx)
    assert ids() == ["new1", "new2", "old1", "old2"]


def test_plan_without_installments_is_a_violation(spark):
    plans = spark.createDataFrame([("p1", 30.0, 3), ("p2", 30.0, 3), ("p3", 30.0, 3)],
                                  "plan_id string, total_amount double, installment_count long")
    inst = spark.createDataFrame([("p1", 10.0)] * 3 + [("p3", 15.0)] * 2, "plan_id string, amount double")
    assert sorted(r.plan_id for r in quality.installment_total_violations(plans, inst).collect()) == ["p2", "p3"]


def test_exact_quantiles_of_a_large_group(spark):
    import numpy as np
    n = 1_100_000
    df = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.lit("hot")).cast("string").alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(9_000_000)) / 100 + F.when(F.col("id") == 3, 1e9).otherwise(0)).alias("v"))
    got = {r.g: (r.q0, r.q1) for r in quality.exact_quantiles(df, "g", "v", [0.25, 0.75]).collect()}
    table = df.toPandas()
    for g, rows in table.groupby(table.g.fillna("-")):
        v = np.sort(rows.v.to_numpy())
        want = tuple(v[max(1, int(np.ceil(p * len(v)))) - 1] for p in (0.25, 0.75))
        assert got[None if g == "-" else g] == want


def test_incremental_job_appends_once(spark, ctx):
    from paylater import jobs
    from paylater.sources import fixtures
    from tests.conftest import SF_SMALL
    target = shared_dir(spark, "t-append")
    sources = fixtures.source_tables(spark, SF_SMALL)
    for table, rows in sources.items():
        first = bronze.add_lineage(rows, table, ctx)
        key = jobs.KEYS[table]
        first.where(F.crc32(F.col(key).cast("binary")) % 4 != 0).write.parquet(f"{target}/bronze/{table}")
    held = {t: spark.read.parquet(f"{target}/bronze/{t}").count() for t in sources}
    added = jobs.append_new(spark, sources, target, ctx)
    assert all(added[t] > 0 for t in sources)
    for table, rows in sources.items():
        # of rows that repeat a key in the load, one is appended
        new = rows.where(F.crc32(F.col(jobs.KEYS[table]).cast("binary")) % 4 == 0).select(jobs.KEYS[table]).distinct()
        assert spark.read.parquet(f"{target}/bronze/{table}").count() == held[table] + new.count()
    assert not any(jobs.append_new(spark, sources, target, ctx).values())


def test_failed_load_leaves_the_old_table(spark, ctx):
    path = shared_dir(spark, "t-crash") + "/transactions"
    row = ("T1", "C1", None, ts("2001-01-01 10:11:12"), 1.5, "AED", "debit_card", "completed")
    good = bronze.add_lineage(spark.createDataFrame([row], schemas.TRANSACTIONS), "transactions", ctx)
    for _ in range(2):
        assert bronze.load_table(good, path, "transactions").count() == 1
    broken = good.withColumn("currency", F.raise_error(F.lit("source down")).cast("string"))
    with pytest.raises(Exception):
        bronze.load_table(broken, path, "transactions")
    assert spark.read.parquet(path).collect() == good.collect()


def test_jdbc_predicates_hold_every_row_once(spark):
    rows = [("CUST000001",), ("CUST5",), ("CUST9'x",), (None,), ("ZZZ",), ("",)]
    df = spark.createDataFrame(rows, "customer_id string")
    for cuts in ([], ["CUST5"], ["CUST9'x", "CUST5", "CUST5", "D"]):
        parts = [df.where(p).count() for p in readers.range_predicates("customer_id", cuts)]
        assert sum(parts) == len(rows) and len(parts) == len(set(cuts)) + 1


def test_ids_pad_but_never_cut(spark):
    from paylater.sources.fixtures import _padded
    df = spark.createDataFrame([(7,), (10008,), (1000007,)], "n long")
    assert [r.i for r in df.select(_padded("M", F.col("n"), 4).alias("i")).collect()] == ["M0007", "M10008", "M1000007"]


def test_shared_folder_must_be_set_on_a_cluster():
    from types import SimpleNamespace
    from paylater import context
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                           sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        context.shared_dir(fake)


def test_csv_read_fails_fast_on_malformed_rows(spark):
    base = shared_dir(spark, "t-badcsv")
    text_schema = ",".join(f"{f.name} string" for f in schemas.TRANSACTIONS.fields)
    bad = spark.createDataFrame(
        [("T1", "C1", "M1", "2001-01-01 10:00:00", "not-a-number", "AED", "x", "completed")], text_schema)
    bad.write.option("header", True).csv(f"{base}/bad")
    with pytest.raises(Exception) as err:
        readers.read_csv(spark, f"{base}/bad", "transactions").collect()
    assert "MALFORMED" in str(err.value).upper() or "FAILFAST" in str(err.value).upper()


def test_register_tables_twice_points_at_latest_files(spark):
    paths = []
    for i in range(2):
        p = shared_dir(spark, "t-reg") + "/t"
        spark.range(i + 1).write.parquet(p)
        paths.append(p)
        bronze.register_tables(spark, "t_layer", {"nums": p})
    assert spark.sql("SELECT count(*) AS n FROM t_layer.nums").first().n == 2
    # the first load's files are untouched: dropping an external table keeps its data
    assert spark.read.parquet(paths[0]).count() == 1
