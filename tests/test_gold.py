import datetime as dt

from pyspark.sql import functions as F

from paylater.plans import customer, merchant, payments, transactions
from tests.conftest import ts

FT = ("transaction_sk string, transaction_id string, customer_sk string, merchant_sk string, "
      "transaction_date_key date, transaction_date timestamp_ntz, amount double, currency string, "
      "payment_method string, status string")
FP = ("plan_sk string, plan_id string, customer_sk string, merchant_sk string, plan_date_key date, "
      "total_amount double, installment_count long, status string, payment_completion_rate double, "
      "defaulted_installments long")
FE = ("event_sk string, customer_sk string, merchant_sk string, event_date_key date, "
      "event_type string, session_id string")


def _txn(spark, rows):
    full = [(f"t{i}", f"T{i}", c, m, d and d.date(), d, a, "AED", "credit_card", s)
            for i, (c, m, d, a, s) in enumerate(rows)]
    return spark.createDataFrame(full, FT)


def _seg(spark, col_fn, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return [r.s for r in df.select(col_fn(F.col("v")).alias("s")).collect()]


def test_value_and_volume_segment_cutoffs(spark):
    assert _seg(spark, customer.value_segment, [0.0, 999.99, 1000.0, 4999.99, 5000.0]) == [
        "No Purchases", "Low Value", "Medium Value", "Medium Value", "High Value"]
    assert _seg(spark, merchant.volume_segment, [0.0, 9999.0, 10000.0, 50000.0]) == [
        "No Sales", "Low Volume", "Medium Volume", "High Volume"]


def test_recency_and_activity_cutoffs_inclusive(spark, ctx):
    vals = [ts("2001-07-03 00:00:00"), ts("2001-07-02 23:59:59"), ts("2001-05-04 00:00:00"),
            ts("2001-02-03 00:00:00"), ts("2001-02-02 23:59:59")]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    got = [r.s for r in df.select(customer.recency_segment(F.col("t"), ctx).alias("s")).collect()]
    assert got == ["Active", "Recent", "Recent", "Lapsed", "Inactive"]
    vals = [ts("2001-07-26 00:00:00"), ts("2001-07-25 23:59:59"), ts("2001-05-04 00:00:00"),
            ts("2001-05-03 23:59:59")]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    got = [r.s for r in df.select(merchant.activity_segment(F.col("t"), ctx).alias("s")).collect()]
    assert got == ["Very Active", "Active", "Moderately Active", "Inactive"]


def test_plan_segment_order(spark):
    df = spark.createDataFrame([(1, 1, 1), (0, 1, 1), (0, 0, 1), (0, 0, 0)], "d long, c long, a long")
    got = [r.s for r in df.select(customer.plan_segment(F.col("d"), F.col("c"), F.col("a")).alias("s"))
           .collect()]
    assert got == ["Defaulted", "Good Standing", "In Progress", "No Plans"]


def test_customer_mart_defaults_and_no_fanout(spark, ctx):
    dim = spark.createDataFrame(
        [("c1", "C1", ts("2001-01-01 00:00:00")), ("c2", "C2", ts("2001-07-30 00:00:00"))],
        "customer_sk string, customer_id string, registration_date timestamp_ntz")
    for c in ["full_name", "email", "phone_number", "country", "city", "status"]:
        dim = dim.withColumn(c, F.lit("x"))
    dim = dim.withColumn("last_login_date", F.lit(None).cast("timestamp_ntz"))
    txn = _txn(spark, [("c1", "m1", ts("2001-08-01 10:00:00"), 5000.0, "completed"),
                       ("c1", "m1", ts("2001-08-01 11:00:00"), 3.0, "failed"),
                       (None, "m1", ts("2001-08-01 11:00:00"), 3.0, "completed")])
    plans = spark.createDataFrame([("p1", "P1", "c1", "m1", dt.date(2001, 8, 1), 100.0, 3, "defaulted", 0.5, 1)], FP)
    ev = spark.createDataFrame([("e1", "c1", None, dt.date(2001, 8, 1), "purchase", "s1"),
                                ("e1", "c1", None, dt.date(2001, 8, 1), "purchase", "s1"),
                                ("e2", None, "m1", dt.date(2001, 8, 1), "search", "s2")], FE)
    out = {r.customer_id: r for r in customer.gold_customer_analytics(dim, txn, plans, ev, ctx).collect()}
    assert len(out) == 2
    c1, c2 = out["C1"], out["C2"]
    assert (c1.total_transactions, c1.total_spent, c1.value_segment) == (1, 5000.0, "High Value")
    assert (c1.total_events, c1.purchase_events, c1.payment_plan_segment) == (1, 1, "Defaulted")
    assert c1.currencies_used == ["AED"] and c1.recency_segment == "Active"
    assert (c2.total_transactions, c2.total_spent, c2.avg_transaction_amount) == (0, 0.0, None)
    assert (c2.value_segment, c2.payment_plan_segment, c2.total_events) == ("No Purchases", "No Plans", 0)
    assert c2.days_since_last_transaction == 3 and c2.recency_segment == "Active"


def test_engagement_keeps_anonymous_group_and_typed_distincts(spark):
    ev = spark.createDataFrame([
        ("e1", None, None, dt.date(2024, 1, 1), "purchase", "s1"),
        ("e1", None, None, dt.date(2024, 1, 1), "search", "s1"),    # same event, two types
        ("e2", None, None, dt.date(2024, 1, 2), "search", "s2"),
        ("e3", "c1", None, dt.date(2024, 1, 1), "app_open", "s3")], FE)
    out = {r.customer_sk: r for r in customer.engagement_metrics(ev).collect()}
    anon = out[None]
    assert (anon.total_events, anon.purchases, anon.searches) == (2, 1, 2)
    assert (anon.total_sessions, anon.active_days) == (2, 2)
    assert out["c1"].app_opens == 1


def test_daily_top_merchants_ties_and_null_merchant(spark, ctx):
    d = ts("2001-08-01 10:00:00")
    rows = [("c", m, d, a, "completed") for m, a in
            [("m3", 10.0), ("m1", 10.0), (None, 50.0), ("m2", 10.0), ("m4", 1.0), ("m5", 0.5), ("m6", 0.1)]]
    dim_m = spark.createDataFrame([("m1", "One")], "merchant_sk string, merchant_name string")
    top = transactions.daily_top_merchants(_txn(spark, rows), dim_m).orderBy("rank").collect()
    assert [(r.rank, r.merchant_sk) for r in top] == [(1, None), (2, "m1"), (3, "m2"), (4, "m3"), (5, "m4")]
    assert top[1].merchant_name == "One" and top[0].merchant_name is None


def test_top_defaulters_threshold_four_and_five(spark):
    rows = []
    for i in range(5):
        rows.append((f"a{i}", f"A{i}", "c", "m5", dt.date(2001, 8, 1), 10.0, 3, "defaulted" if i == 0 else "active", None, 0))
    for i in range(4):
        rows.append((f"b{i}", f"B{i}", "c", "m4", dt.date(2001, 8, 1), 10.0, 3, "defaulted", None, 0))
    plans = spark.createDataFrame(rows, FP)
    dim_m = spark.createDataFrame([("m5", "Five"), ("m4", "Four")], "merchant_sk string, merchant_name string")
    got = payments.daily_top_defaulters(plans, dim_m).collect()
    assert [(r.merchant_sk, r.plan_count, r.default_rate) for r in got] == [("m5", 5, 0.2)]
    got1 = payments.daily_top_defaulters(plans, dim_m, min_plans=1).orderBy("rank").collect()
    assert [r.merchant_sk for r in got1] == ["m4", "m5"]


def test_gold_marts_empty_arrays_when_no_candidates(spark, ctx):
    from paylater.operators.dims import dim_dates
    plans = spark.createDataFrame(
        [("a", "A", "c", "m1", dt.date(2001, 8, 1), 10.0, 3, "active", 1.0, 0)], FP)
    dim_m = spark.createDataFrame([("m1", "One")], "merchant_sk string, merchant_name string")
    r = payments.gold_payment_analytics(plans, dim_m, dim_dates(spark, ctx), ctx).first()
    assert r.top_defaulting_merchants == [] and len(r.top_merchants_by_volume) == 1
    assert r.top_merchants_by_volume[0].merchant_name == "One"
    assert r.plan_month_name == "August" and r.weighted_completion_rate == 1.0


def test_null_day_gets_totals_but_no_breakdown_or_top_list(spark, ctx):
    from paylater.operators.dims import dim_dates
    rows = [("c", "m1", None, 10.0, "completed"), ("c", "m1", ts("2001-08-01 10:00:00"), 5.0, "completed")]
    txn = _txn(spark, rows)
    dim_m = spark.createDataFrame([("m1", "One")], "merchant_sk string, merchant_name string")
    out = {r.transaction_date_key: r for r in
           transactions.gold_transaction_analytics(txn, dim_m, dim_dates(spark, ctx), ctx).collect()}
    null_day = out[None]
    assert null_day.transaction_count == 1 and null_day.total_amount == 10.0
    assert null_day.completed_count == 0 and null_day.completed_amount == 0.0
    assert null_day.top_merchants == [] and null_day.transaction_date is None
    day = out[dt.date(2001, 8, 1)]
    assert day.completed_count == 1 and len(day.top_merchants) == 1


def test_top_lists_as_json_objects(spark, ctx):
    from paylater.operators.topk import collect_ranked, json_objects
    d = ts("2001-08-01 10:00:00")
    rows = [("c", "m1", d, 12345678.5, "completed"), ("c", None, d, 2.0, "completed")]
    dim_m = spark.createDataFrame([("m1", "One")], "merchant_sk string, merchant_name string")
    ranked = transactions.daily_top_merchants(_txn(spark, rows), dim_m)
    top = collect_ranked(ranked, [transactions.DATE], "rank", transactions.TOP_PAYLOAD, "top")
    got = top.select(json_objects("top").alias("j")).first().j
    assert got == ['{"merchant_sk":"m1","merchant_name":"One","transaction_count":1,"total_amount":12345678.50}',
                   '{"merchant_sk":null,"merchant_name":null,"transaction_count":1,"total_amount":2.00}']


def test_top_k_lookup_matches_join_then_rank_with_duplicate_dimension_keys(spark):
    from paylater.operators.topk import top_k_rows, top_k_with_lookup
    day = dt.date(2001, 8, 1)
    cand = spark.createDataFrame([(day, f"m{i}", float(10 - i)) for i in range(7)],
                                 "d date, merchant_sk string, total_amount double")
    dim = spark.createDataFrame([("m1", "One"), ("m1", "Uno"), ("m3", "Three"), ("m9", "Nine")],
                                "merchant_sk string, merchant_name string")
    order = [F.col("total_amount").desc(), F.col("merchant_sk").asc_nulls_last()]
    got = top_k_with_lookup(cand, ["d"], order, 5, ["merchant_sk", "total_amount"], dim, "merchant_sk",
                            ["merchant_name"], ["merchant_sk", "merchant_name", "total_amount"])
    joined = cand.join(dim, "merchant_sk", "left")
    want = top_k_rows(joined, ["d"], order + [F.col("merchant_name").asc_nulls_last()], 5,
                      ["merchant_sk", "merchant_name", "total_amount"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert [r.merchant_sk for r in got.orderBy("rank").collect()] == ["m0", "m1", "m1", "m2", "m3"]
