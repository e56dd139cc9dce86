"""Handmade edge cases from SURVEY §5.2 not covered elsewhere."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from paylater.operators import facts
from paylater.plans import customer, metrics
from paylater.queries import wh
from tests.conftest import SF_SMALL, ts

STG_TXN = ("transaction_id string, customer_id string, merchant_id string, transaction_date timestamp_ntz, "
           "amount double, currency string, payment_method string, status string, _etl_extracted_at timestamp_ntz")


def test_duplicate_dimension_keys_fan_out_like_a_left_join(spark, ctx):
    txn = spark.createDataFrame(
        [("T1", "C1", "M1", ts("2001-01-01 10:00:00"), 10.0, "AED", "x", "completed", None)], STG_TXN)
    dc = spark.createDataFrame([("C1",), ("C1",)], "customer_id string")
    dm = spark.createDataFrame([("M1",)], "merchant_id string")
    ft = facts.fact_transactions(txn, dc, dm, ctx)
    sk = hashlib.md5(b"C1").hexdigest()
    assert [r.customer_sk for r in ft.collect()] == [sk, sk]
    # distinct counts are not inflated by the fan-out, sums are (as in the reference)
    pm = customer.purchase_metrics(ft).first()
    assert pm.customer_sk == sk and pm.total_transactions == 1 and pm.total_spent == 20.0


def test_in_progress_counts_as_active(spark):
    plans = spark.createDataFrame(
        [("P1", dt.date(2001, 1, 1), "in_progress"), ("P2", dt.date(2001, 1, 1), "active"),
         ("P3", dt.date(2001, 1, 1), "completed"), ("P4", dt.date(2001, 3, 1), "defaulted")],
        "plan_id string, plan_date_key date, status string")
    r = metrics.plan_status(plans).first()
    assert (r.total_plans, r.active_plans, r.completed_plans, r.defaulted_plans) == (4, 2, 1, 1)
    r = metrics.plan_status(plans, dt.date(2001, 1, 1), dt.date(2001, 1, 31)).first()
    assert r.total_plans == 3
    assert metrics.plan_status(plans, None, dt.date(2001, 1, 31)).first().total_plans == 4


def test_marts_on_empty_facts_keep_every_dimension_row(spark, ctx):
    dim = spark.createDataFrame([("c1", "C1", ts("2001-07-01 00:00:00"))],
                                "customer_sk string, customer_id string, registration_date timestamp_ntz")
    for c in ["full_name", "email", "phone_number", "country", "city", "status"]:
        dim = dim.withColumn(c, F.lit(None).cast("string"))
    dim = dim.withColumn("last_login_date", F.lit(None).cast("timestamp_ntz"))
    txn = spark.createDataFrame([], "transaction_sk string, transaction_id string, customer_sk string, "
                                    "merchant_sk string, transaction_date timestamp_ntz, amount double, "
                                    "currency string, status string")
    plans = spark.createDataFrame([], "plan_sk string, customer_sk string, status string, "
                                      "payment_completion_rate double")
    ev = spark.createDataFrame([], "event_sk string, customer_sk string, event_date_key date, "
                                   "event_type string, session_id string")
    r = customer.gold_customer_analytics(dim, txn, plans, ev, ctx).first()
    assert (r.total_transactions, r.total_spent, r.total_events, r.value_segment) == (0, 0.0, 0, "No Purchases")
    assert r.recency_segment == "Recent" and r.currencies_used is None   # 32 days before as_of


def test_kpi_window_matches_brute_force(spark):
    ft = wh(spark, SF_SMALL).silver.fact_transactions
    start, end = dt.date(2001, 2, 1), dt.date(2001, 2, 28)
    got = {r.date: (r.transaction_count, r.transaction_value)
           for r in metrics.daily(ft, start, end).collect()}
    pdf = ft.select("transaction_date_key", "amount").toPandas()
    pdf = pdf[(pdf.transaction_date_key >= start) & (pdf.transaction_date_key <= end)]
    want = {d: (len(g), round(sum(round(a * 100) for a in g.amount) / 100, 2))
            for d, g in pdf.groupby("transaction_date_key")}
    assert set(got) == set(want) and len(got) == 28
    for d in want:
        assert got[d][0] == want[d][0] and abs(got[d][1] - want[d][1]) < 1e-9
    tot = metrics.totals(ft, start, end).first()
    assert tot.total_transactions == len(pdf)
    assert tot.active_customers == ft.where(F.col("transaction_date_key").between(start, end)) \
        .select("customer_sk").where(F.col("customer_sk").isNotNull()).distinct().count()


def test_dashboard_bundle_runs_every_panel(spark):
    s = wh(spark, SF_SMALL).silver
    panels = metrics.dashboard(s, dt.date(2001, 1, 1), dt.date(2001, 6, 30))
    assert len(panels) == 9
    assert panels["totals"].first().total_transactions == panels["daily"].agg(F.sum("transaction_count")).first()[0]
    assert panels["top_customers"].count() == 10
