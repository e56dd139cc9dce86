"""A hot merchant and many NULL keys, forced through shuffle joins with skew splitting."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paylater.context import RunContext
from paylater.operators import dims, facts
from paylater.plans import customer, merchant

N = 6000


def _sources(spark):
    ids = spark.range(N).withColumn("i", F.col("id"))
    txn = ids.select(
        F.concat(F.lit("T"), F.col("i").cast("string")).alias("transaction_id"),
        F.concat(F.lit("C"), (F.col("i") % 97).cast("string")).alias("customer_id"),
        # 40% of rows on merchant M0, 30% without a merchant, the rest spread
        F.when(F.col("i") % 10 < 4, F.lit("M0"))
        .when(F.col("i") % 10 < 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("M"), (F.col("i") % 13).cast("string"))).alias("merchant_id"),
        F.to_timestamp_ntz(F.lit("2001-07-01 10:00:00")).alias("transaction_date"),
        ((F.col("i") % 500) / F.lit(4.0)).alias("amount"),
        F.lit("AED").alias("currency"), F.lit("debit_card").alias("payment_method"),
        F.when(F.col("i") % 5 == 0, "failed").otherwise("completed").alias("status"),
        F.to_timestamp_ntz(F.lit("2001-08-02 00:00:00")).alias("_etl_extracted_at"))
    cust = spark.range(97).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id"),
        *[F.lit("x").alias(c) for c in ["email", "first_name", "last_name", "phone_number",
                                        "country", "city", "status"]],
        F.to_timestamp_ntz(F.lit("2000-01-01 00:00:00")).alias("registration_date"),
        F.lit(None).cast("timestamp_ntz").alias("last_login_date"),
        F.to_timestamp_ntz(F.lit("2001-08-02 00:00:00")).alias("_etl_extracted_at"))
    merch = spark.range(13).select(
        F.concat(F.lit("M"), F.col("id").cast("string")).alias("merchant_id"),
        *[F.lit("x").alias(c) for c in ["merchant_name", "category", "country", "integration_type",
                                        "status"]],
        F.to_timestamp_ntz(F.lit("1999-01-01 00:00:00")).alias("onboarding_date"),
        F.to_timestamp_ntz(F.lit("2001-08-02 00:00:00")).alias("_etl_extracted_at"))
    return txn, cust, merch


def _results(spark, ctx):
    txn, cust, merch = _sources(spark)
    dc, dm = dims.dim_customers(cust, ctx), dims.dim_merchants(merch, ctx)
    ft = facts.fact_transactions(txn, dc, dm, ctx)
    empty_plans = spark.createDataFrame([], "plan_sk string, customer_sk string, merchant_sk string, "
                                        "status string, payment_completion_rate double, "
                                        "defaulted_installments long")
    empty_events = spark.createDataFrame([], "event_sk string, customer_sk string, merchant_sk string, "
                                         "event_date_key date, event_type string, session_id string")
    gm = merchant.gold_merchant_analytics(dm, ft, empty_plans, empty_events, ctx).drop("dbt_updated_at")
    pm = customer.purchase_metrics(ft)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return (sorted(map(tuple, ft.drop("dbt_updated_at").collect()), key=key),
            sorted(map(tuple, gm.collect()), key=key), sorted(map(tuple, pm.collect()), key=key))


@pytest.fixture
def skew_conf(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in keys}
    yield keys
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_and_null_keys_same_result_through_shuffle_joins(spark, skew_conf):
    ctx = RunContext(as_of=dt.date(2001, 8, 2))
    expected = _results(spark, ctx)
    for k, v in skew_conf.items():
        spark.conf.set(k, v)
    got = _results(spark, ctx)
    assert got == expected
    ft_rows, gm_rows, _ = got
    assert len(ft_rows) == N

    def merchant_of(i):
        return "M0" if i % 10 < 4 else None if i % 10 < 7 else f"M{i % 13}"

    hot = [r for r in gm_rows if r[1] == "M0"][0]
    assert hot[9] == sum(1 for i in range(N) if merchant_of(i) == "M0" and i % 5 != 0)


def test_null_keys_spread_in_shuffle_join_plan(spark, skew_conf):
    ctx = RunContext(as_of=dt.date(2001, 8, 2))
    for k, v in skew_conf.items():
        spark.conf.set(k, v)
    txn, cust, merch = _sources(spark)
    ft = facts.fact_transactions(txn, dims.dim_customers(cust, ctx), dims.dim_merchants(merch, ctx), ctx)
    ft.write.format("noop").mode("overwrite").save()
    text = ft._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "xxhash64(transaction_id" in text


@pytest.mark.parametrize("partitions", ["200", "20000"])
def test_hot_day_is_split_over_several_files(spark, partitions):
    # above 2,000 partitions Spark sees mean block sizes only, but for spark.shuffle.accurateBlockSkewedFactor
    import collections
    import re as _re
    from paylater.context import shared_dir
    from paylater.plans.warehouse import write_by_day
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("2001-01-01").cast("date"))          # a third on one day
        .otherwise(F.date_add(F.lit("2001-02-01").cast("date"), (F.col("id") % 20).cast("int")))
        .alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    path = shared_dir(spark, "t-hot-day")
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.shuffle.partitions": partitions,
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions}     # cluster-like: days rarely share a partition
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        write_by_day(df, path, "d")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = spark.read.parquet(path).inputFiles()
    per_day = collections.Counter(_re.search(r"d=([0-9-]+)", f).group(1) for f in files)
    assert per_day["2001-01-01"] >= 3
    small = sorted(c for d, c in per_day.items() if d != "2001-01-01")
    assert len(small) == 20 and small[len(small) // 2] <= 2
    assert spark.read.parquet(path).count() == n
