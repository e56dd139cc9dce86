"""Customer mart C1-C8.

Each metric group is aggregated on its own (completed purchases, plans,
engagement), keyed by ``customer_sk``, and then left-joined onto the
customer dimension.  Aggregating before joining keeps one row per customer
(no fan-out) and leaves each join with per-customer rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylater.context import RunContext
from paylater.functions import day_diff, days_before, ratio
from paylater.functions.money import MONEY, rate_avg
from paylater.functions.distinct import multi_counts

ENGAGEMENT_TYPES = {  # output column -> event type
    "app_opens": "app_open", "product_views": "product_view", "searches": "search",
    "add_to_carts": "add_to_cart", "checkouts": "checkout", "purchases": "purchase",
}
# Segment cut points.
HIGH_VALUE, MEDIUM_VALUE = 5000, 1000
RECENCY_DAYS = [(30, "Active"), (90, "Recent"), (180, "Lapsed")]


def purchase_metrics(fact_txn: DataFrame, by: str = "customer_sk") -> DataFrame:
    """Completed transactions per customer (NULL customer is its own group)."""
    done = fact_txn.where(F.col("status") == "completed")
    out = multi_counts(
        done, [by], {"total_transactions": "transaction_sk", "unique_merchants_count": "merchant_sk"},
        partials={"_sum": (F.col("amount").cast(MONEY), "sum"), "_n": (F.col("amount"), "count"),
                  "first_transaction_date": (F.col("transaction_date"), "min"),
                  "last_transaction_date": (F.col("transaction_date"), "max")},
        sets={"currencies_used": "currency"})
    total = F.col("_sum").cast("double")
    return out.select(by, "total_transactions", total.alias("total_spent"),
                      ratio(total, F.col("_n")).alias("avg_transaction_amount"),
                      "first_transaction_date", "last_transaction_date", "unique_merchants_count",
                      "currencies_used")


def plan_metrics(fact_plans: DataFrame, by: str = "customer_sk",
                 extra: list | None = None) -> DataFrame:
    """Plans per customer; status counts are row counts, not distinct."""
    st = F.col("status")
    return fact_plans.groupBy(by).agg(
        F.count_distinct("plan_sk").alias("total_payment_plans"),
        F.count_if(st == "active").alias("active_payment_plans"),
        F.count_if(st == "completed").alias("completed_payment_plans"),
        F.count_if(st == "defaulted").alias("defaulted_payment_plans"),
        rate_avg("payment_completion_rate").alias("avg_payment_completion_rate"),
        *(extra or []),
    )


def engagement_metrics(fact_events: DataFrame, by: str = "customer_sk") -> DataFrame:
    """Distinct events, sessions, active days and distinct events per type.

    All distinct counts come from one scan (see ``multi_counts``).  The NULL customer
    (anonymous events) is its own group.
    """
    et = F.col("event_type")
    out = multi_counts(fact_events, [by], {"total_events": "event_sk", "total_sessions": "session_id",
                                           "active_days": "event_date_key"},
                       flags={name: ("total_events", et == t) for name, t in ENGAGEMENT_TYPES.items()})
    return out.select(by, "total_events", "total_sessions", "active_days", *ENGAGEMENT_TYPES)


def value_segment(total_spent) -> F.Column:
    """C6."""
    return (F.when(total_spent == 0, "No Purchases")
            .when(total_spent >= HIGH_VALUE, "High Value")
            .when(total_spent >= MEDIUM_VALUE, "Medium Value")
            .otherwise("Low Value"))


def recency_segment(last_seen, ctx: RunContext) -> F.Column:
    """Cutoffs are inclusive, at midnight ``n`` days before ``as_of``."""
    out = None
    for days, label in RECENCY_DAYS:
        cond = last_seen >= days_before(ctx.as_of, days)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("Inactive")


def plan_segment(defaulted, completed, active) -> F.Column:
    """The first matching state wins."""
    return (F.when(defaulted > 0, "Defaulted")
            .when(completed > 0, "Good Standing")
            .when(active > 0, "In Progress")
            .otherwise("No Plans"))


COUNTS = ["total_transactions", "unique_merchants_count", "total_payment_plans", "active_payment_plans",
          "completed_payment_plans", "defaulted_payment_plans", "total_events", "total_sessions", "active_days",
          *ENGAGEMENT_TYPES]
METRICS = [*COUNTS, "total_spent", "avg_transaction_amount", "first_transaction_date", "last_transaction_date",
           "currencies_used", "avg_payment_completion_rate"]
DIMENSION = ["customer_sk", "customer_id", "full_name", "email", "phone_number", "country", "city",
             "registration_date", "last_login_date", "status"]


def with_metrics(dim_customers: DataFrame, fact_txn: DataFrame, fact_plans: DataFrame,
                 fact_events: DataFrame) -> DataFrame:
    """Customers of the dimension with their metrics (C4): nothing here depends on the run date.

    Rows without a customer key cannot match the dimension, so they are
    dropped before aggregating (the anonymous-event group never reaches a
    shuffle here).
    """
    known = F.col("customer_sk").isNotNull()
    j = (dim_customers.select(*DIMENSION).join(purchase_metrics(fact_txn.where(known)), "customer_sk", "left")
         .join(plan_metrics(fact_plans.where(known)), "customer_sk", "left")
         .join(engagement_metrics(fact_events.where(known)), "customer_sk", "left"))
    return j.select(*DIMENSION, *METRICS)


def held_metrics(mart: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """``with_metrics`` of customers whose metrics the last version of the mart holds."""
    held = (mart.withColumnRenamed("purchase_events", "purchases").select("customer_sk", *METRICS)
            .dropDuplicates(["customer_sk"]))          # rows of a repeated customer have the same metrics
    return dim_customers.select(*DIMENSION).join(held, "customer_sk", "left").select(*DIMENSION, *METRICS)


def from_metrics(j: DataFrame, ctx: RunContext) -> DataFrame:
    """C8 from customers with their metrics: defaults, days since, segments."""
    z = F.lit(0).cast("bigint")
    spent = F.coalesce(F.col("total_spent"), F.lit(0.0))
    last_seen = F.coalesce(F.col("last_transaction_date"), F.col("registration_date"))
    n = {c: F.coalesce(F.col(c), z) for c in COUNTS}
    return j.select(
        *DIMENSION,
        n["total_transactions"].alias("total_transactions"),
        spent.alias("total_spent"),
        "avg_transaction_amount", "first_transaction_date", "last_transaction_date",
        n["unique_merchants_count"].alias("unique_merchants_count"),
        "currencies_used",
        day_diff("registration_date", ctx.as_of_col).alias("days_since_registration"),
        day_diff(last_seen, ctx.as_of_col).alias("days_since_last_transaction"),
        *[n[c].alias(c) for c in ["total_payment_plans", "active_payment_plans",
                                  "completed_payment_plans", "defaulted_payment_plans"]],
        "avg_payment_completion_rate",
        *[n[c].alias(c) for c in ["total_events", "total_sessions", "active_days", "app_opens",
                                  "product_views", "searches", "add_to_carts", "checkouts"]],
        n["purchases"].alias("purchase_events"),
        value_segment(spent).alias("value_segment"),
        recency_segment(last_seen, ctx).alias("recency_segment"),
        plan_segment(n["defaulted_payment_plans"], n["completed_payment_plans"],
                     n["active_payment_plans"]).alias("payment_plan_segment"),
        ctx.as_of_col.alias("snapshot_date"),
        ctx.updated_at_col.alias("dbt_updated_at"),
    )


def gold_customer_analytics(dim_customers: DataFrame, fact_txn: DataFrame, fact_plans: DataFrame,
                            fact_events: DataFrame, ctx: RunContext) -> DataFrame:
    """One row per customer of the dimension."""
    return from_metrics(with_metrics(dim_customers, fact_txn, fact_plans, fact_events), ctx)
