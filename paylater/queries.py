"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query builds the warehouse lazily from the driver's tables in
``sf_dir`` with the fixed run context, then applies one operator of the
inventory.  Outputs leave out ``dbt_updated_at`` (a run stamp) and turn
arrays into sorted ``|``-joined text so that values compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylater import schemas
from paylater.context import TEST_CONTEXT, shared_dir
from paylater.functions import surrogate_key
from paylater.operators import facts, incremental, quality, schedule
from paylater.operators.topk import json_objects
from paylater.plans import customer, merchant, metrics, payments, transactions, warehouse
from paylater.sources import bronze as bronze_ops
from paylater.sources import readers
from paylater.streaming import events as event_stream

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def wh(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """The lazy warehouse over ``sf_dir``."""
    return warehouse.from_test_tables(spark, sf_dir, TEST_CONTEXT)


def comparable(df: DataFrame) -> DataFrame:
    """Drop the run stamp; arrays of text become sorted '|'-joined text, top-k lists their JSON texts in rank order."""
    cols = []
    for f in df.schema.fields:
        if f.name == "dbt_updated_at":
            continue
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            cols.append(F.array_join(F.sort_array(F.col(f.name)), "|").alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            names = f.dataType.elementType.fieldNames()
            cols.append(F.array_join(json_objects(
                f.name, tuple(n for n in names if n == "total_amount"),
                tuple(n for n in names if n == "default_rate")), "|").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- bronze / staging

@query("bronze_lineage")
def q_bronze_lineage(spark, sf_dir):
    return wh(spark, sf_dir).bronze["transactions"]


@query("bronze_row_counts")
def q_bronze_row_counts(spark, sf_dir):
    return bronze_ops.row_counts(wh(spark, sf_dir).bronze)


def _stg(table: str) -> QueryFn:
    def run(spark, sf_dir):
        return wh(spark, sf_dir).staging[table]
    run.__name__ = f"q_stg_{table}"
    return run


for _t in ["customers", "merchants", "transactions", "payment_plans", "installments", "user_events"]:
    REGISTRY[f"stg_{_t}"] = _stg(_t)


# ---------------------------------------------------------------- silver

@query("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    e = wh(spark, sf_dir).staging["user_events"]
    return e.select("event_id", surrogate_key("customer_id", "merchant_id").alias("customer_merchant_sk"))


@query("dim_customers")
def q_dim_customers(spark, sf_dir):
    return comparable(wh(spark, sf_dir).silver.dim_customers)


@query("dim_merchants")
def q_dim_merchants(spark, sf_dir):
    return comparable(wh(spark, sf_dir).silver.dim_merchants)


@query("dim_dates")
def q_dim_dates(spark, sf_dir):
    """The whole calendar, with the number of transactions of each day."""
    w = wh(spark, sf_dir).silver
    days = (w.fact_transactions.groupBy(F.col("transaction_date_key").alias("date_key"))
            .agg(F.count("*").alias("n_transactions")))
    return comparable(w.dim_dates.join(days, "date_key", "left")
                      .withColumn("n_transactions", F.coalesce("n_transactions", F.lit(0).cast("bigint"))))


@query("fact_transactions")
def q_fact_transactions(spark, sf_dir):
    return comparable(wh(spark, sf_dir).silver.fact_transactions)


@query("plan_installment_metrics")
def q_plan_installment_metrics(spark, sf_dir):
    return facts.plan_installment_metrics(wh(spark, sf_dir).staging["installments"])


@query("fact_payment_plans")
def q_fact_payment_plans(spark, sf_dir):
    return comparable(wh(spark, sf_dir).silver.fact_payment_plans)


@query("fact_customer_events")
def q_fact_customer_events(spark, sf_dir):
    return comparable(wh(spark, sf_dir).silver.fact_customer_events)


@query("installment_schedule")
def q_installment_schedule(spark, sf_dir):
    return schedule.installment_schedule(wh(spark, sf_dir).staging["payment_plans"])


@query("installment_status")
def q_installment_status(spark, sf_dir):
    sched = schedule.installment_schedule(wh(spark, sf_dir).staging["payment_plans"])
    draw = (F.substring("plan_id", 5, 100).cast("bigint") * 7 + F.col("installment_number") * 13) % 100
    return schedule.installment_status(sched, TEST_CONTEXT, draw)


# ---------------------------------------------------------------- gold: customers

def _gold_customer(spark, sf_dir):
    w = wh(spark, sf_dir)
    s = w.silver
    return customer.gold_customer_analytics(s.dim_customers, s.fact_transactions,
                                            s.fact_payment_plans, s.fact_customer_events, w.ctx)


@query("customer_purchase_metrics")
def q_customer_purchase_metrics(spark, sf_dir):
    return comparable(customer.purchase_metrics(wh(spark, sf_dir).silver.fact_transactions))


@query("customer_plan_metrics")
def q_customer_plan_metrics(spark, sf_dir):
    return comparable(customer.plan_metrics(wh(spark, sf_dir).silver.fact_payment_plans))


@query("customer_engagement_metrics")
def q_customer_engagement_metrics(spark, sf_dir):
    return customer.engagement_metrics(wh(spark, sf_dir).silver.fact_customer_events)


@query("customer_value_segments")
def q_customer_value_segments(spark, sf_dir):
    return _gold_customer(spark, sf_dir).select("customer_id", "total_spent", "value_segment")


@query("customer_recency_segments")
def q_customer_recency_segments(spark, sf_dir):
    return _gold_customer(spark, sf_dir).select(
        "customer_id", "last_transaction_date", "days_since_last_transaction", "recency_segment")


@query("customer_plan_segments")
def q_customer_plan_segments(spark, sf_dir):
    return _gold_customer(spark, sf_dir).select(
        "customer_id", "active_payment_plans", "completed_payment_plans",
        "defaulted_payment_plans", "payment_plan_segment")


@query("gold_customer_analytics")
def q_gold_customer_analytics(spark, sf_dir):
    return comparable(_gold_customer(spark, sf_dir))


# ---------------------------------------------------------------- gold: merchants

def _gold_merchant(spark, sf_dir):
    w = wh(spark, sf_dir)
    s = w.silver
    return merchant.gold_merchant_analytics(s.dim_merchants, s.fact_transactions,
                                            s.fact_payment_plans, s.fact_customer_events, w.ctx)


@query("merchant_sales_metrics")
def q_merchant_sales_metrics(spark, sf_dir):
    return comparable(merchant.sales_metrics(wh(spark, sf_dir).silver.fact_transactions))


@query("merchant_plan_metrics")
def q_merchant_plan_metrics(spark, sf_dir):
    return comparable(merchant.merchant_plan_metrics(wh(spark, sf_dir).silver.fact_payment_plans))


@query("merchant_engagement_metrics")
def q_merchant_engagement_metrics(spark, sf_dir):
    return merchant.merchant_engagement(wh(spark, sf_dir).silver.fact_customer_events)


@query("merchant_recent_metrics")
def q_merchant_recent_metrics(spark, sf_dir):
    w = wh(spark, sf_dir)
    return merchant.recent_metrics(w.silver.fact_transactions, w.ctx)


@query("merchant_ratios")
def q_merchant_ratios(spark, sf_dir):
    return _gold_merchant(spark, sf_dir).select(
        "merchant_id", "default_rate", "view_to_purchase_rate", "avg_customer_value")


@query("merchant_volume_segments")
def q_merchant_volume_segments(spark, sf_dir):
    return _gold_merchant(spark, sf_dir).select("merchant_id", "total_sales_amount", "volume_segment")


@query("merchant_activity_segments")
def q_merchant_activity_segments(spark, sf_dir):
    return _gold_merchant(spark, sf_dir).select(
        "merchant_id", "last_transaction_date", "days_since_last_transaction", "activity_segment")


@query("gold_merchant_analytics")
def q_gold_merchant_analytics(spark, sf_dir):
    return comparable(_gold_merchant(spark, sf_dir))


# ---------------------------------------------------------------- gold: daily transactions

@query("daily_transactions")
def q_daily_transactions(spark, sf_dir):
    return comparable(transactions.daily_transactions(wh(spark, sf_dir).silver.fact_transactions))


@query("daily_merchant_transactions")
def q_daily_merchant_transactions(spark, sf_dir):
    return transactions.daily_merchant_transactions(wh(spark, sf_dir).silver.fact_transactions)


@query("daily_status_transactions")
def q_daily_status_transactions(spark, sf_dir):
    return transactions.daily_status_transactions(wh(spark, sf_dir).silver.fact_transactions)


@query("daily_status_pivot")
def q_daily_status_pivot(spark, sf_dir):
    return transactions.daily_status_pivot(wh(spark, sf_dir).silver.fact_transactions)


@query("daily_top_merchants")
def q_daily_top_merchants(spark, sf_dir):
    s = wh(spark, sf_dir).silver
    return transactions.daily_top_merchants(s.fact_transactions, s.dim_merchants)


@query("gold_transaction_analytics")
def q_gold_transaction_analytics(spark, sf_dir):
    w = wh(spark, sf_dir)
    s = w.silver
    return comparable(transactions.gold_transaction_analytics(
        s.fact_transactions, s.dim_merchants, s.dim_dates, w.ctx))


# ---------------------------------------------------------------- gold: daily payment plans

@query("daily_payment_plans")
def q_daily_payment_plans(spark, sf_dir):
    return comparable(payments.daily_payment_plans(wh(spark, sf_dir).silver.fact_payment_plans))


@query("daily_weighted_completion")
def q_daily_weighted_completion(spark, sf_dir):
    d = payments.daily_payment_plans(wh(spark, sf_dir).silver.fact_payment_plans)
    return comparable(d.select(payments.DATE, "total_amount", "weighted_completion_rate"))


@query("merchant_daily_plans")
def q_merchant_daily_plans(spark, sf_dir):
    return payments.merchant_daily_plans(wh(spark, sf_dir).silver.fact_payment_plans)


@query("daily_top_defaulters")
def q_daily_top_defaulters(spark, sf_dir):
    s = wh(spark, sf_dir).silver
    return payments.daily_top_defaulters(s.fact_payment_plans, s.dim_merchants)


@query("daily_top_defaulters_min1")
def q_daily_top_defaulters_min1(spark, sf_dir):
    s = wh(spark, sf_dir).silver
    return payments.daily_top_defaulters(s.fact_payment_plans, s.dim_merchants, min_plans=1)


@query("daily_top_plan_merchants")
def q_daily_top_plan_merchants(spark, sf_dir):
    s = wh(spark, sf_dir).silver
    return payments.daily_top_plan_merchants(s.fact_payment_plans, s.dim_merchants)


@query("gold_payment_analytics")
def q_gold_payment_analytics(spark, sf_dir):
    w = wh(spark, sf_dir)
    s = w.silver
    return comparable(payments.gold_payment_analytics(
        s.fact_payment_plans, s.dim_merchants, s.dim_dates, w.ctx))


# ---------------------------------------------------------------- dashboard KPIs

# The dashboard's date range: a month inside the data.
KPI_START, KPI_END = dt.date(2001, 3, 1), dt.date(2001, 3, 31)


@query("kpi_date_bounds")
def q_kpi_date_bounds(spark, sf_dir):
    return metrics.date_bounds(wh(spark, sf_dir).silver.fact_transactions)


@query("kpi_totals")
def q_kpi_totals(spark, sf_dir):
    return metrics.totals(wh(spark, sf_dir).silver.fact_transactions, KPI_START, KPI_END)


@query("kpi_daily")
def q_kpi_daily(spark, sf_dir):
    return metrics.daily(wh(spark, sf_dir).silver.fact_transactions, KPI_START, KPI_END)


@query("kpi_payment_methods")
def q_kpi_payment_methods(spark, sf_dir):
    return metrics.payment_methods(wh(spark, sf_dir).silver.fact_transactions, KPI_START, KPI_END)


@query("kpi_top_customers")
def q_kpi_top_customers(spark, sf_dir):
    s = wh(spark, sf_dir).silver
    return metrics.top_customers(s.fact_transactions, s.dim_customers, KPI_START, KPI_END)


@query("kpi_plan_status")
def q_kpi_plan_status(spark, sf_dir):
    return metrics.plan_status(wh(spark, sf_dir).silver.fact_payment_plans, KPI_START, KPI_END)


@query("kpi_completion_trend")
def q_kpi_completion_trend(spark, sf_dir):
    # all months: one month would be one row
    return comparable(metrics.completion_trend(wh(spark, sf_dir).silver.fact_payment_plans))


@query("kpi_plans_by_installments")
def q_kpi_plans_by_installments(spark, sf_dir):
    return metrics.plans_by_installments(wh(spark, sf_dir).silver.fact_payment_plans,
                                         KPI_START, KPI_END)


@query("kpi_merchant_default_rates")
def q_kpi_merchant_default_rates(spark, sf_dir):
    s = wh(spark, sf_dir).silver
    return metrics.merchant_default_rates(s.fact_payment_plans, s.dim_merchants, KPI_START, KPI_END)


# ---------------------------------------------------------------- data quality

@query("dq_unique")
def q_dq_unique(spark, sf_dir):
    stg = wh(spark, sf_dir).staging
    out = None
    for table, col in quality.UNIQUE:
        part = quality.unique_violations(stg[table], col).select(
            F.lit(table).alias("table"), F.lit(col).alias("column"),
            F.col(col).cast("string").alias("value"), "n_records")
        out = part if out is None else out.unionByName(part)
    return out


@query("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    return quality.not_null_report(wh(spark, sf_dir).staging)


@query("dq_relationships")
def q_dq_relationships(spark, sf_dir):
    return quality.relationships_report(wh(spark, sf_dir).staging)


@query("dq_report")
def q_dq_report(spark, sf_dir):
    return quality.dq_report(wh(spark, sf_dir).staging)


@query("dq_business_rules")
def q_dq_business_rules(spark, sf_dir):
    return quality.business_rules_report(wh(spark, sf_dir).staging)


@query("dq_outliers")
def q_dq_outliers(spark, sf_dir):
    ft = wh(spark, sf_dir).silver.fact_transactions
    return quality.outliers(ft, "merchant_sk", "amount", "transaction_id")


# ---------------------------------------------------------------- ingestion

@query("bronze_csv_load")
def q_bronze_csv_load(spark, sf_dir):
    """Transactions staged as CSV, read back typed (date columns parsed
    from text), stamped with lineage and loaded as a Parquet bronze table."""
    w = wh(spark, sf_dir)
    base = shared_dir(spark, "bronze-csv")
    src = w.bronze["transactions"].select(*schemas.TRANSACTIONS.fieldNames())
    readers.write_csv(src, f"{base}/source/transactions")
    extracted = readers.read_csv_text_dates(spark, f"{base}/source/transactions", "transactions")
    return bronze_ops.load_table(bronze_ops.add_lineage(extracted, "transactions", w.ctx),
                                 f"{base}/bronze/transactions", "transactions")


# The target of the incremental queries: events on these days are loaded, and
# one later event whose time lies in the future; the batch is the whole event table.
LOADED_DAYS = ("2001-07-10 00:00:00", "2001-07-19 00:00:00")
FUTURE_EVENT = "17"


def _incremental_inputs(spark, sf_dir):
    events = wh(spark, sf_dir).staging["user_events"]
    low, high = (F.to_timestamp_ntz(F.lit(d)) for d in LOADED_DAYS)
    time = F.col("event_timestamp")
    target = events.where(((time >= low) & (time < high)) | (F.col("event_id") == FUTURE_EVENT))
    ahead = F.timestamp_add("DAY", F.lit(400), time).cast("timestamp_ntz")
    ahead_of_time = F.when(F.col("event_id") == FUTURE_EVENT, ahead).otherwise(time)
    return (events.withColumn("event_timestamp", ahead_of_time), target.withColumn("event_timestamp", ahead_of_time))


@query("incremental_new_rows")
def q_incremental_new_rows(spark, sf_dir):
    incoming, target = _incremental_inputs(spark, sf_dir)
    return incremental.new_by_key(incoming, target, ["event_id"])


@query("incremental_new_rows_windowed")
def q_incremental_new_rows_windowed(spark, sf_dir):
    incoming, target = _incremental_inputs(spark, sf_dir)
    return incremental.new_since(incoming, target, ["event_id"], "event_timestamp")


# Events from this instant on arrive first; the older ones come in a later run.
LATE_BEFORE = "2001-07-18 00:00:00"


@query("stream_user_events")
def q_stream_user_events(spark, sf_dir):
    """The newer events as files, twice; in a second run the older ones, and the newer once more."""
    w = wh(spark, sf_dir)
    base = shared_dir(spark, "event-stream")
    src = w.bronze["user_events"].select(*schemas.USER_EVENTS.fieldNames())
    newer = src.where(F.col("event_timestamp") >= F.to_timestamp_ntz(F.lit(LATE_BEFORE)))
    for run, rows in enumerate((newer.unionAll(newer), src)):
        readers.write_csv(rows, f"{base}/incoming/run-{run}")
        event_stream.ingest_event_files(spark, f"{base}/incoming/*", f"{base}/bronze", f"{base}/checkpoint", w.ctx)
    return event_stream.read_events(spark, f"{base}/bronze").drop(event_stream.DAY, event_stream.BATCH)
