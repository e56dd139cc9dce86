import datetime as dt
import hashlib

from pyspark.sql import functions as F

from paylater.context import RunContext
from paylater.operators import dims, facts
from paylater.operators.schedule import installment_schedule, installment_status
from tests.conftest import ts

INST = ("installment_id string, plan_id string, installment_number long, amount double, "
        "due_date timestamp_ntz, paid_date timestamp_ntz, status string")


def test_date_spine_excludes_end_and_calendar_flags(spark):
    ctx = RunContext(as_of=dt.date(2024, 2, 29), calendar_start=dt.date(2023, 12, 31),
                     calendar_end=dt.date(2024, 3, 2))
    cal = {r.date_key: r for r in dims.dim_dates(spark, ctx).collect()}
    assert min(cal) == dt.date(2023, 12, 31) and max(cal) == dt.date(2024, 3, 1)
    leap = cal[dt.date(2024, 2, 29)]
    assert leap.is_last_day_of_month and leap.is_current_day and leap.day_of_year == 60
    assert leap.day_name == "Thursday" and leap.day_of_week == 4 and not leap.is_weekend
    ye = cal[dt.date(2023, 12, 31)]
    assert ye.day_name == "Sunday" and ye.day_of_week == 0 and ye.is_weekend
    assert ye.quarter == "Q4" and ye.year_month == "2023-12" and ye.month_name == "December"
    assert cal[dt.date(2024, 3, 1)].is_first_day_of_month


def test_default_calendar_is_reference_range(spark):
    ctx = RunContext(as_of=dt.date(2025, 1, 1))
    spine = dims.date_spine(spark, ctx.calendar_start, ctx.calendar_end_exclusive)
    r = spine.agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert r[0] == dt.date(2020, 1, 1) and r[1] == dt.date(2027, 12, 31)


def test_dim_customers_full_name_keeps_space(spark, ctx):
    stg = spark.createDataFrame(
        [("C1", None, "Doe"), ("C2", "Ann", None)], "customer_id string, first_name string, last_name string")
    for c in ["email", "phone_number", "country", "city", "status"]:
        stg = stg.withColumn(c, F.lit(None).cast("string"))
    for c in ["registration_date", "last_login_date", "_etl_extracted_at"]:
        stg = stg.withColumn(c, F.lit(None).cast("timestamp_ntz"))
    names = {r.customer_id: r.full_name for r in dims.dim_customers(stg, ctx).collect()}
    assert names == {"C1": " Doe", "C2": "Ann "}


def test_installment_metrics_duplicates_nulls_and_late_midnight(spark):
    rows = [
        ("I1", "P1", 1, 10.0, ts("2001-01-01 23:00:00"), ts("2001-01-02 01:00:00"), "paid_late"),
        ("I1", "P1", 1, 10.0, ts("2001-01-01 23:00:00"), ts("2001-01-02 01:00:00"), "paid_late"),
        ("I2", "P1", 2, 10.0, ts("2001-02-01 00:00:00"), None, "defaulted"),
        (None, "P1", 3, 5.0, ts("2001-03-01 00:00:00"), ts("2001-03-01 00:00:00"), "paid"),
        ("I9", "P2", 1, 7.0, ts("2001-03-01 00:00:00"), None, "scheduled"),
    ]
    m = {r.plan_id: r for r in facts.plan_installment_metrics(spark.createDataFrame(rows, INST)).collect()}
    p1 = m["P1"]
    assert (p1.total_installments, p1.paid_installments, p1.defaulted_installments) == (2, 1, 1)
    assert p1.total_paid_amount == 25.0          # sums count every row, distinct counts do not
    assert p1.avg_days_late == 1.0               # 23:00 -> 01:00 crosses one midnight
    p2 = m["P2"]
    assert (p2.total_installments, p2.paid_installments, p2.total_paid_amount, p2.avg_days_late) == (1, 0, 0.0, None)


def test_fact_payment_plans_zero_total_and_missing_installments(spark, ctx):
    plans = spark.createDataFrame(
        [("P1", "T1", "C1", "M1", ts("2001-01-01 10:00:00"), 0.0, 3, 0.0, "active", ts("2001-08-02 00:00:00")),
         ("P2", "T2", "C1", None, ts("2001-01-02 10:00:00"), 30.0, 3, 10.0, "active", ts("2001-08-02 00:00:00"))],
        "plan_id string, transaction_id string, customer_id string, merchant_id string, plan_date timestamp_ntz, "
        "total_amount double, installment_count long, first_installment_amount double, status string, "
        "_etl_extracted_at timestamp_ntz")
    inst = spark.createDataFrame([], INST)
    dc = spark.createDataFrame([("C1",)], "customer_id string")
    dm = spark.createDataFrame([("M1",)], "merchant_id string")
    ft = spark.createDataFrame([("T1",)], "transaction_id string")
    out = {r.plan_id: r for r in facts.fact_payment_plans(plans, inst, dc, dm, ft, ctx).collect()}
    assert out["P1"].payment_completion_rate is None and out["P1"].total_installments == 0
    assert out["P2"].payment_completion_rate == 0.0 and out["P2"].merchant_sk is None
    assert out["P2"].transaction_sk is None
    assert out["P1"].transaction_sk == hashlib.md5(b"T1").hexdigest()
    assert out["P1"].customer_sk == hashlib.md5(b"C1").hexdigest()


def test_schedule_month_end_clamp_and_rounding(spark, ctx):
    plans = spark.createDataFrame([("PLAN1", ts("2001-01-31 10:30:00"), 100.0, 3)],
                                  "plan_id string, plan_date timestamp_ntz, total_amount double, installment_count long")
    rows = installment_schedule(plans).orderBy("installment_number").collect()
    assert [r.due_date for r in rows] == [ts("2001-01-31 10:30:00"), ts("2001-02-28 10:30:00"),
                                         ts("2001-03-31 10:30:00")]
    assert [r.amount for r in rows] == [33.33] * 3
    assert rows[0].installment_id == "INST1_1"
    half = spark.createDataFrame([("PLAN2", ts("2001-01-01 00:00:00"), 0.06, 12)],
                                 "plan_id string, plan_date timestamp_ntz, total_amount double, installment_count long")
    assert installment_schedule(half).first().amount == 0.01   # 0.5 cent rounds up


def test_installment_status_rule(spark, ctx):
    df = spark.createDataFrame(
        [(ts("2001-08-03 00:00:00"), 99), (ts("2001-08-02 00:00:00"), 97), (ts("2001-07-01 00:00:00"), 86),
         (ts("2001-07-01 00:00:00"), 3)], "due_date timestamp_ntz, h long")
    out = installment_status(df, ctx, F.col("h")).collect()
    assert [(r.status, r.paid_date) for r in out] == [
        ("scheduled", None), ("defaulted", None), ("paid_late", ts("2001-07-28 00:00:00")),
        ("paid", ts("2001-06-28 00:00:00"))]


def test_date_spine_empty_when_range_is_empty(spark):
    assert dims.date_spine(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 1)).count() == 0
    ctx = RunContext(as_of=dt.date(2001, 8, 2))          # reference start 2020 > run date + 3 years
    assert dims.dim_dates(spark, ctx).count() == 0
    assert dims.date_spine(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 2)).count() == 1


def test_schedule_has_no_rows_for_zero_or_missing_count(spark):
    plans = spark.createDataFrame(
        [("PLAN1", ts("2001-01-31 10:30:00"), 100.0, 0), ("PLAN2", ts("2001-01-31 10:30:00"), 100.0, None),
         ("PLAN3", ts("2001-01-31 10:30:00"), 100.0, -2), ("PLAN4", ts("2001-01-31 10:30:00"), 100.0, 1)],
        "plan_id string, plan_date timestamp_ntz, total_amount double, installment_count long")
    rows = installment_schedule(plans).collect()
    assert [(r.plan_id, r.installment_number, r.amount) for r in rows] == [("PLAN4", 1, 100.0)]
