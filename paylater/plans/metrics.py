"""Dashboard metrics K1-K12 as functions of the silver tables and a date range.

The date range (K2) is inclusive and applies to the fact's date key; a
missing bound means no filter.  It is a plain predicate on a column of the
fact, so over Parquet it is pushed to the scan.  Joins to a dimension run
after the fact is reduced to one row per key (pre-aggregation), so a hot
customer or merchant never meets the join unreduced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylater.functions import money_sum, ratio
from paylater.functions.money import rate_avg

TOP_N = 10
MIN_PLANS = 5
# Plan statuses counted as active on the dashboard ('in_progress' is never
# produced by the source, but is accepted).
ACTIVE_STATUSES = ["active", "in_progress"]


def in_range(df: DataFrame, col: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """K2: ``start <= col <= end`` when both bounds are given."""
    if start is None or end is None:
        return df
    return df.where(F.col(col).between(F.lit(start), F.lit(end)))


def date_bounds(fact_txn: DataFrame) -> DataFrame:
    """K1."""
    return fact_txn.agg(F.min("transaction_date_key").alias("min_date"),
                        F.max("transaction_date_key").alias("max_date"))


def stored_date_bounds(spark: SparkSession, path: str, column: str = "transaction_date_key") -> DataFrame:
    """K1 of a fact that is stored by day: from the names of its folders, no file is opened."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    days = sorted(n.partition("=")[2] for n in names
                  if n.startswith(f"{column}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__"))
    bounds = tuple(dt.date.fromisoformat(d) for d in (days[0], days[-1])) if days else (None, None)
    return spark.createDataFrame([bounds], "min_date date, max_date date")


def totals(fact_txn: DataFrame, start=None, end=None) -> DataFrame:
    """K3-K5: transactions, value, active customers in one pass."""
    t = in_range(fact_txn, "transaction_date_key", start, end)
    return t.agg(F.count(F.lit(1)).alias("total_transactions"),
                 money_sum("amount").alias("total_value"),
                 F.count_distinct("customer_sk").alias("active_customers"))


def daily(fact_txn: DataFrame, start=None, end=None) -> DataFrame:
    """K6: count and value per day, ordered by day."""
    t = in_range(fact_txn, "transaction_date_key", start, end)
    return (t.groupBy(F.col("transaction_date_key").alias("date"))
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 money_sum("amount").alias("transaction_value"))
            .orderBy("date"))


def payment_methods(fact_txn: DataFrame, start=None, end=None) -> DataFrame:
    """K7: distribution by payment method, largest first."""
    t = in_range(fact_txn, "transaction_date_key", start, end)
    return (t.groupBy("payment_method")
            .agg(F.count(F.lit(1)).alias("count"), money_sum("amount").alias("total_amount"))
            .orderBy(F.col("count").desc(), F.col("payment_method").asc_nulls_last()))


def top_customers(fact_txn: DataFrame, dim_customers: DataFrame, start=None, end=None,
                  n: int = TOP_N) -> DataFrame:
    """K8: top ``n`` customers by spend (inner join; name NULL if a part is NULL)."""
    t = in_range(fact_txn, "transaction_date_key", start, end)
    per_sk = t.groupBy("customer_sk").agg(
        F.count("transaction_id").alias("_n"),
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("_spend"))
    named = per_sk.join(
        dim_customers.select("customer_sk", "customer_id",
                             F.concat("first_name", F.lit(" "), "last_name").alias("customer_name")),
        "customer_sk", "inner")
    return (named.groupBy("customer_id", "customer_name")
            .agg(F.sum("_n").cast("bigint").alias("transaction_count"),
                 F.sum("_spend").cast("double").alias("total_spend"))
            .orderBy(F.col("total_spend").desc_nulls_last(), F.col("customer_id").asc_nulls_last(),
                     F.col("customer_name").asc_nulls_last())
            .limit(n))


def plan_status(fact_plans: DataFrame, start=None, end=None) -> DataFrame:
    """K9."""
    p = in_range(fact_plans, "plan_date_key", start, end)
    st = F.col("status")
    return p.agg(F.count(F.lit(1)).alias("total_plans"),
                 F.count_if(st.isin(*ACTIVE_STATUSES)).alias("active_plans"),
                 F.count_if(st == "completed").alias("completed_plans"),
                 F.count_if(st == "defaulted").alias("defaulted_plans"))


def completion_trend(fact_plans: DataFrame, start=None, end=None) -> DataFrame:
    """Mean completion rate per month (first day of the month)."""
    p = in_range(fact_plans, "plan_date_key", start, end)
    return (p.groupBy(F.trunc("plan_date_key", "MM").alias("month"))
            .agg(rate_avg("payment_completion_rate").alias("avg_completion_rate"))
            .orderBy("month"))


def plans_by_installments(fact_plans: DataFrame, start=None, end=None) -> DataFrame:
    """K11."""
    p = in_range(fact_plans, "plan_date_key", start, end)
    return (p.groupBy("installment_count").agg(F.count(F.lit(1)).alias("plan_count"))
            .orderBy("installment_count"))


def merchant_default_rates(fact_plans: DataFrame, dim_merchants: DataFrame, start=None, end=None,
                           n: int = TOP_N, min_plans: int = MIN_PLANS) -> DataFrame:
    """Merchants (grouped by name) with at least ``min_plans`` plans, highest default rate first."""
    p = in_range(fact_plans, "plan_date_key", start, end)
    per_sk = p.groupBy("merchant_sk").agg(
        F.count("plan_id").alias("_plans"),
        F.count_if(F.col("status") == "defaulted").alias("_defaulted"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("_amount"))
    named = per_sk.join(dim_merchants.select("merchant_sk", "merchant_name"), "merchant_sk", "inner")
    by_name = named.groupBy("merchant_name").agg(
        F.sum("_plans").cast("bigint").alias("total_plans"),
        F.sum("_defaulted").cast("bigint").alias("defaulted_plans"),
        F.sum("_amount").cast("double").alias("total_amount"))
    return (by_name.where(F.col("total_plans") >= min_plans)
            .select("merchant_name", "total_plans", "defaulted_plans",
                    ratio("defaulted_plans", "total_plans", 0.0).alias("default_rate"),
                    "total_amount")
            .orderBy(F.col("default_rate").desc_nulls_last(), F.col("merchant_name").asc_nulls_last())
            .limit(n))


def dashboard(silver, start: dt.date | None = None, end: dt.date | None = None) -> dict[str, DataFrame]:
    """All dashboard queries for one date range (lazy; the caller runs the ones it shows).

    ``silver`` is any object with the silver tables as attributes.  The
    default range is open, i.e. every row.
    """
    ft, fp = silver.fact_transactions, silver.fact_payment_plans
    return {
        "date_bounds": date_bounds(ft),
        "totals": totals(ft, start, end),
        "daily": daily(ft, start, end),
        "payment_methods": payment_methods(ft, start, end),
        "top_customers": top_customers(ft, silver.dim_customers, start, end),
        "plan_status": plan_status(fp, start, end),
        "completion_trend": completion_trend(fp, start, end),
        "plans_by_installments": plans_by_installments(fp, start, end),
        "merchant_default_rates": merchant_default_rates(fp, silver.dim_merchants, start, end),
    }
