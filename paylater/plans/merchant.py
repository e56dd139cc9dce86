"""Merchant mart R1-R9.

Same shape as the customer mart, keyed by ``merchant_sk``.  One merchant
may carry a third of all rows; every aggregate here either has map-side
partial aggregation or first shuffles by ``(merchant, other key)``, so the
hot merchant is combined across all tasks before its single group is
finished.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylater.context import RunContext
from paylater.functions import day_diff, days_before, ratio
from paylater.functions.distinct import multi_counts
from paylater.functions.money import MONEY
from paylater.plans.customer import plan_metrics

ENGAGEMENT_TYPES = {"product_views": "product_view", "add_to_carts": "add_to_cart",
                    "checkouts": "checkout", "purchases": "purchase"}
# Segment cut points.
HIGH_VOLUME, MEDIUM_VOLUME = 50000, 10000
ACTIVITY_DAYS = [(7, "Very Active"), (30, "Active"), (90, "Moderately Active")]
RECENT_DAYS = 30


def all_sales(fact_txn: DataFrame, ctx: RunContext | None = None, days: int = RECENT_DAYS) -> DataFrame:
    """R1 and, with ``ctx``, R4 from one scan: completed transactions per merchant (NULL is its own group)."""
    done = fact_txn.where(F.col("status") == "completed")
    flags, more = {}, {}
    if ctx is not None:
        recent = F.coalesce(F.col("transaction_date") >= days_before(ctx.as_of, days), F.lit(False))
        flags = {"transactions_last_30d": ("total_transactions", recent),
                 "customers_last_30d": ("unique_customers", recent)}
        more = {"_recent_sum": (F.when(recent, F.col("amount").cast(MONEY)), "sum")}
    out = multi_counts(
        done, ["merchant_sk"], {"total_transactions": "transaction_sk", "unique_customers": "customer_sk"}, flags,
        {"_sum": (F.col("amount").cast(MONEY), "sum"), "_n": (F.col("amount"), "count"),
         "first_transaction_date": (F.col("transaction_date"), "min"),
         "last_transaction_date": (F.col("transaction_date"), "max"), **more},
        {"currencies_used": "currency"})
    total = F.col("_sum").cast("double")
    return out.select("merchant_sk", "total_transactions", "unique_customers", total.alias("total_sales_amount"),
                      ratio(total, F.col("_n")).alias("avg_transaction_amount"),
                      "first_transaction_date", "last_transaction_date", "currencies_used", *flags,
                      *[F.col(c).cast("double").alias("sales_amount_last_30d") for c in more])


def sales_metrics(fact_txn: DataFrame) -> DataFrame:
    """Completed transactions per merchant (NULL merchant is its own group)."""
    return all_sales(fact_txn)


def merchant_plan_metrics(fact_plans: DataFrame) -> DataFrame:
    """R2: plan metrics per merchant (as C2) plus defaulted installments."""
    return plan_metrics(fact_plans, by="merchant_sk", extra=[
        F.sum("defaulted_installments").cast("bigint").alias("total_defaulted_installments")])


def merchant_engagement(fact_events: DataFrame) -> DataFrame:
    """Events with a merchant: distinct events, engaged customers, typed counts."""
    ev = fact_events.where(F.col("merchant_sk").isNotNull())
    et = F.col("event_type")
    out = multi_counts(ev, ["merchant_sk"], {"total_events": "event_sk", "engaged_customers": "customer_sk"},
                       flags={name: ("total_events", et == t) for name, t in ENGAGEMENT_TYPES.items()})
    return out.select("merchant_sk", "total_events", "engaged_customers", *ENGAGEMENT_TYPES)


def recent_metrics(fact_txn: DataFrame, ctx: RunContext, days: int = RECENT_DAYS) -> DataFrame:
    """Completed transactions of the last ``days`` days (midnight cutoff, inclusive)."""
    since = days_before(ctx.as_of, days)
    # the day key as well, so that only the folders of these days are read
    recent = fact_txn.where((F.col("status") == "completed") & (F.col("transaction_date") >= since)
                            & (F.col("transaction_date_key") >= since.cast("date")))
    out = multi_counts(recent, ["merchant_sk"], {"transactions_last_30d": "transaction_sk",
                                                 "customers_last_30d": "customer_sk"},
                       partials={"_sum": (F.col("amount").cast(MONEY), "sum")})
    return out.select("merchant_sk", "transactions_last_30d", "customers_last_30d",
                      F.col("_sum").cast("double").alias("sales_amount_last_30d"))


def volume_segment(total_sales) -> F.Column:
    """R7."""
    return (F.when(total_sales == 0, "No Sales")
            .when(total_sales >= HIGH_VOLUME, "High Volume")
            .when(total_sales >= MEDIUM_VOLUME, "Medium Volume")
            .otherwise("Low Volume"))


def activity_segment(last_seen, ctx: RunContext) -> F.Column:
    """R8."""
    out = None
    for days, label in ACTIVITY_DAYS:
        cond = last_seen >= days_before(ctx.as_of, days)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("Inactive")


RECENT = ["transactions_last_30d", "customers_last_30d", "sales_amount_last_30d"]
METRICS = ["total_transactions", "unique_customers", "total_sales_amount", "avg_transaction_amount",
           "first_transaction_date", "last_transaction_date", "currencies_used", "total_payment_plans",
           "active_payment_plans", "completed_payment_plans", "defaulted_payment_plans",
           "total_defaulted_installments", "avg_payment_completion_rate", "total_events", "engaged_customers",
           *ENGAGEMENT_TYPES]
DIMENSION = ["merchant_sk", "merchant_id", "merchant_name", "category", "country", "integration_type",
             "onboarding_date", "status", "days_since_onboarding"]


def with_metrics(dim_merchants: DataFrame, fact_txn: DataFrame, fact_plans: DataFrame, fact_events: DataFrame,
                 ctx: RunContext) -> DataFrame:
    """Merchants of the dimension with their metrics."""
    known = F.col("merchant_sk").isNotNull()
    j = (dim_merchants.select(*DIMENSION).join(all_sales(fact_txn.where(known), ctx), "merchant_sk", "left")
         .join(merchant_plan_metrics(fact_plans.where(known)), "merchant_sk", "left")
         .join(merchant_engagement(fact_events), "merchant_sk", "left"))
    return j.select(*DIMENSION, *METRICS, *RECENT)


def held_metrics(mart: DataFrame, dim_merchants: DataFrame, fact_txn: DataFrame, ctx: RunContext) -> DataFrame:
    """``with_metrics`` of merchants whose metrics the last version of the mart holds; only the sales of the
    last 30 days are read again, from the folders of these days."""
    held = (mart.withColumnRenamed("purchase_events", "purchases").select("merchant_sk", *METRICS)
            .dropDuplicates(["merchant_sk"]))          # rows of a repeated merchant have the same metrics
    recent = recent_metrics(fact_txn.where(F.col("merchant_sk").isNotNull()), ctx)
    return (dim_merchants.select(*DIMENSION).join(held, "merchant_sk", "left").join(recent, "merchant_sk", "left")
            .select(*DIMENSION, *METRICS, *RECENT))


def from_metrics(j: DataFrame, ctx: RunContext) -> DataFrame:
    """R9 from merchants with their metrics: defaults, ratios (R6), segments."""
    z = F.lit(0).cast("bigint")

    def n(c):
        return F.coalesce(F.col(c), z)

    sales = F.coalesce(F.col("total_sales_amount"), F.lit(0.0))
    last_seen = F.coalesce(F.col("last_transaction_date"), F.col("onboarding_date"))
    return j.select(
        *DIMENSION,
        n("total_transactions").alias("total_transactions"),
        n("unique_customers").alias("unique_customers"),
        sales.alias("total_sales_amount"),
        "avg_transaction_amount", "first_transaction_date", "last_transaction_date", "currencies_used",
        day_diff(last_seen, ctx.as_of_col).alias("days_since_last_transaction"),
        n("total_payment_plans").alias("total_payment_plans"),
        n("active_payment_plans").alias("active_payment_plans"),
        n("completed_payment_plans").alias("completed_payment_plans"),
        n("defaulted_payment_plans").alias("defaulted_payment_plans"),
        n("total_defaulted_installments").alias("total_defaulted_installments"),
        "avg_payment_completion_rate",
        ratio(n("defaulted_payment_plans"), n("total_payment_plans"), 0.0).alias("default_rate"),
        n("total_events").alias("total_events"),
        n("engaged_customers").alias("engaged_customers"),
        n("product_views").alias("product_views"),
        n("add_to_carts").alias("add_to_carts"),
        n("checkouts").alias("checkouts"),
        n("purchases").alias("purchase_events"),
        ratio(n("purchases"), n("product_views"), 0.0).alias("view_to_purchase_rate"),
        n("transactions_last_30d").alias("transactions_last_30d"),
        n("customers_last_30d").alias("customers_last_30d"),
        F.coalesce(F.col("sales_amount_last_30d"), F.lit(0.0)).alias("sales_amount_last_30d"),
        ratio(sales, n("unique_customers"), 0.0).alias("avg_customer_value"),
        volume_segment(sales).alias("volume_segment"),
        activity_segment(last_seen, ctx).alias("activity_segment"),
        ctx.as_of_col.alias("snapshot_date"),
        ctx.updated_at_col.alias("dbt_updated_at"),
    )


def gold_merchant_analytics(dim_merchants: DataFrame, fact_txn: DataFrame, fact_plans: DataFrame,
                            fact_events: DataFrame, ctx: RunContext) -> DataFrame:
    """One row per merchant of the dimension."""
    return from_metrics(with_metrics(dim_merchants, fact_txn, fact_plans, fact_events, ctx), ctx)
