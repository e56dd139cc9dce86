"""Physical-plan checks: what must (not) appear in the executed plans."""

import datetime as dt

import pytest

from paylater.context import TEST_CONTEXT, shared_dir
from paylater.operators import facts
from paylater.plans import customer, metrics, payments, transactions, warehouse
from paylater.sources import fixtures
from paylater.sources.bronze import bronze_frames
from tests.conftest import SF_SMALL


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    base = shared_dir(spark, "t-plans")
    src = {}
    for name, df in fixtures.source_tables(spark, SF_SMALL).items():
        df.write.parquet(f"{base}/src/{name}")
        src[name] = spark.read.parquet(f"{base}/src/{name}")
    return warehouse.build_warehouse(spark, bronze_frames(src, TEST_CONTEXT), base, TEST_CONTEXT)


def test_no_python_udfs_in_marts(spark, stored):
    _, s = stored
    for df in [
        customer.gold_customer_analytics(s.dim_customers, s.fact_transactions, s.fact_payment_plans,
                                         s.fact_customer_events, TEST_CONTEXT),
        transactions.gold_transaction_analytics(s.fact_transactions, s.dim_merchants, s.dim_dates,
                                                TEST_CONTEXT),
        payments.gold_payment_analytics(s.fact_payment_plans, s.dim_merchants, s.dim_dates, TEST_CONTEXT),
    ]:
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_top_k_limits_before_shuffle(spark, stored):
    _, s = stored
    df = transactions.daily_top_merchants(s.fact_transactions, s.dim_merchants)
    df.collect()
    assert "WindowGroupLimit" in plan_text(df)


def test_kpi_date_filter_pushed_to_scan(spark, stored):
    _, s = stored
    df = metrics.daily(s.fact_transactions, dt.date(2001, 1, 1), dt.date(2001, 1, 31))
    text = df._jdf.queryExecution().executedPlan().toString()
    # facts are written by day, so a date range reads the folders of its days only
    assert "PartitionFilters: [isnotnull(transaction_date_key" in text
    assert "ReadSchema: struct<amount:double>" in text


def test_installment_rollup_combines_before_each_shuffle(spark, stored):
    stg, _ = stored
    df = facts.plan_installment_metrics(stg["installments"])
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2
    assert "Expand" not in text
    # every exchange is fed by a partial (map-side) aggregate
    assert text.count("HashAggregate(keys=[plan_id") >= 4


def test_typed_engagement_counts_without_expand(spark, stored):
    _, s = stored
    from paylater.functions.distinct import keyed_counts
    from pyspark.sql import functions as F
    et = F.col("event_type")
    df = keyed_counts(s.fact_customer_events, ["customer_sk"], "event_sk",
                      {n: et == t for n, t in customer.ENGAGEMENT_TYPES.items()}, "total_events")
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_date_partitioned_facts_prune_folders_and_match(spark, stored):
    from pyspark.sql import functions as F
    stg, s = stored
    base = shared_dir(spark, "t-by-day")
    bronze_tables = {t: spark.read.parquet(p) for t, p in _bronze_paths(stg).items()}
    _, part = warehouse.build_warehouse(spark, bronze_tables, base, TEST_CONTEXT, partition_facts_by_day=True)
    assert part.fact_transactions.columns == s.fact_transactions.columns
    assert dict(part.fact_transactions.dtypes)["transaction_date_key"] == "date"
    start, end = dt.date(2001, 1, 1), dt.date(2001, 1, 31)
    df = metrics.daily(part.fact_transactions, start, end)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date_key" in text
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, metrics.daily(s.fact_transactions, start, end).collect()))
    n_files = len(part.fact_transactions.inputFiles())
    n_days = part.fact_transactions.select("transaction_date_key").distinct().count()
    assert n_files <= 2 * n_days          # small days are coalesced, not split
    assert part.fact_payment_plans.count() == s.fact_payment_plans.count()
    assert part.fact_customer_events.exceptAll(s.fact_customer_events).count() == 0


def _bronze_paths(stg):
    return {t: df.inputFiles()[0].rsplit("/", 1)[0] for t, df in stg.items()}


def test_marts_shuffle_once_per_aggregate_step_without_broadcast(spark, stored):
    """With dimensions too large to broadcast (the 100 TB case), the per-key
    aggregates and the dimension meet on one hash partitioning: the marts
    add no shuffle beyond the aggregates' own and the dimension's."""
    import re
    _, s = stored
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        cust = customer.gold_customer_analytics(s.dim_customers, s.fact_transactions, s.fact_payment_plans,
                                                s.fact_customer_events, TEST_CONTEXT)
        text = cust._jdf.queryExecution().executedPlan().toString()
        # distinct transactions and merchants are two narrow reductions, without copied rows
        assert len(re.findall(r"Exchange hashpartitioning", text)) <= 13
        assert "coalesce(customer_sk" not in text
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _scans(df, column: str) -> int:
    """Scans of a fact, told by a column that only it has, in the executed plan."""
    import re
    text = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", text))


def test_marts_scan_each_fact_twice_at_most_and_copy_no_rows(spark, stored):
    """In the default layout (folders by day), also where nothing is small enough to broadcast."""
    from paylater.plans import merchant
    _, s = stored
    ft, fp, fe = s.fact_transactions, s.fact_payment_plans, s.fact_customer_events
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for limit in (None, "-1"):
            if limit:
                for k in keys:
                    spark.conf.set(k, limit)
            marts = [(transactions.gold_transaction_analytics(ft, s.dim_merchants, s.dim_dates, TEST_CONTEXT),
                      {"transaction_sk": 2}),
                     (payments.gold_payment_analytics(fp, s.dim_merchants, s.dim_dates, TEST_CONTEXT), {"plan_sk": 2}),
                     (customer.gold_customer_analytics(s.dim_customers, ft, fp, fe, TEST_CONTEXT),
                      {"transaction_sk": 1, "event_sk": 1, "plan_sk": 1}),
                     (merchant.gold_merchant_analytics(s.dim_merchants, ft, fp, fe, TEST_CONTEXT),
                      {"transaction_sk": 1, "event_sk": 1, "plan_sk": 1})]
            for df, most in marts:
                text = df._jdf.queryExecution().executedPlan().toString()
                assert "Expand" not in text and "dynamicpruning" not in text
                for column, n in most.items():
                    assert 1 <= _scans(df, column) <= n, (column, n)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
