"""Daily transaction mart D1-D7.

Grouping is by day (few, large groups): every aggregate has map-side
partial aggregation, and distinct counts shuffle by ``(day, value)``, so a
day's rows are spread over all tasks.  The mart scans its fact twice: for the
totals of a day with their status breakdown, and for its merchants.  The
calendar has a row count fixed by its date range; Spark broadcasts it by its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylater import schemas
from paylater.functions import money_sum, ratio
from paylater.functions.distinct import join_days, multi_counts
from paylater.functions.money import MONEY
from paylater.operators.topk import collect_ranked, top_k_with_lookup

DATE = "transaction_date_key"
TOP_K = 5


def daily_totals(fact_txn: DataFrame) -> DataFrame:
    """D1 and D4 from one scan: totals of a day, and its ``<status>_count`` / ``<status>_amount``."""
    status, money = F.col("status"), F.col("amount").cast(MONEY)
    every = multi_counts(
        fact_txn, [DATE],
        {"transaction_count": "transaction_sk", "customer_count": "customer_sk", "merchant_count": "merchant_sk"},
        flags={f"{s}_count": ("transaction_count", status == s) for s in schemas.TRANSACTION_STATUSES},
        partials={"_sum": (money, "sum"), "_n": (F.col("amount"), "count"), "min_amount": (F.col("amount"), "min"),
                  "max_amount": (F.col("amount"), "max"),
                  **{f"{s}_amount": (F.when(status == s, money), "sum") for s in schemas.TRANSACTION_STATUSES}},
        sets={"currencies": "currency"})
    total = F.col("_sum").cast("double")
    return every.select(
        DATE, "transaction_count", "customer_count", "merchant_count", total.alias("total_amount"),
        ratio(total, F.col("_n")).alias("avg_amount"), "min_amount", "max_amount", "currencies",
        *[c for s in schemas.TRANSACTION_STATUSES
          for c in (f"{s}_count", F.coalesce(F.col(f"{s}_amount").cast("double"), F.lit(0.0)).alias(f"{s}_amount"))])


def daily_transactions(fact_txn: DataFrame) -> DataFrame:
    """All statuses per day."""
    return daily_totals(fact_txn).select(
        DATE, "transaction_count", "customer_count", "merchant_count", "total_amount", "avg_amount", "min_amount",
        "max_amount", "currencies")


def daily_merchant_transactions(fact_txn: DataFrame) -> DataFrame:
    """Per day and merchant; the NULL merchant is its own group."""
    every = multi_counts(fact_txn, [DATE, "merchant_sk"],
                         {"transaction_count": "transaction_sk", "customer_count": "customer_sk"},
                         partials={"_sum": (F.col("amount").cast(MONEY), "sum"), "_n": (F.col("amount"), "count")})
    total = F.col("_sum").cast("double")
    return every.select(DATE, "merchant_sk", "transaction_count", "customer_count", total.alias("total_amount"),
                        ratio(total, F.col("_n")).alias("avg_amount"))


def daily_status_transactions(fact_txn: DataFrame) -> DataFrame:
    """D3: per day and status."""
    return fact_txn.groupBy(DATE, "status").agg(
        F.count_distinct("transaction_sk").alias("transaction_count"),
        money_sum("amount").alias("total_amount"),
    )


def daily_status_pivot(fact_txn: DataFrame) -> DataFrame:
    """One row per day, ``<status>_count`` / ``<status>_amount`` for the five statuses (0 if absent)."""
    st = daily_status_transactions(fact_txn)
    piv = (st.groupBy(DATE).pivot("status", schemas.TRANSACTION_STATUSES)
           .agg(F.first("transaction_count").alias("count"), F.first("total_amount").alias("amount")))
    cols = []
    for s in schemas.TRANSACTION_STATUSES:
        cols.append(F.coalesce(F.col(f"{s}_count"), F.lit(0).cast("bigint")).alias(f"{s}_count"))
        cols.append(F.coalesce(F.col(f"{s}_amount"), F.lit(0.0)).alias(f"{s}_amount"))
    return piv.select(DATE, *cols)


def _ranked_top_merchants(fact_txn: DataFrame, dim_merchants: DataFrame, k: int,
                          rank_col: str = "rank") -> DataFrame:
    """Top-k merchants per day; names are looked up for the top rows only."""
    return top_k_with_lookup(daily_merchant_transactions(fact_txn), [DATE], top_order(), k,
                             ["merchant_sk", "transaction_count", "total_amount"],
                             dim_merchants, "merchant_sk", ["merchant_name"], TOP_PAYLOAD, rank_col)


def top_order():
    """Largest amount first; ties by merchant key (NULL last)."""
    return [F.col("total_amount").desc_nulls_last(), F.col("merchant_sk").asc_nulls_last()]


TOP_PAYLOAD = ["merchant_sk", "merchant_name", "transaction_count", "total_amount"]


def daily_top_merchants(fact_txn: DataFrame, dim_merchants: DataFrame, k: int = TOP_K) -> DataFrame:
    """D6 as rows: (day, rank, merchant_sk, merchant_name, transaction_count, total_amount)."""
    return _ranked_top_merchants(fact_txn, dim_merchants, k)


def gold_transaction_analytics(fact_txn: DataFrame, dim_merchants: DataFrame,
                               dim_dates: DataFrame, ctx, k: int = TOP_K) -> DataFrame:
    """Daily totals, calendar attributes, status pivot and the top-k merchant array."""
    top = collect_ranked(_ranked_top_merchants(fact_txn, dim_merchants, k, "_rank"), [DATE], "_rank",
                         TOP_PAYLOAD, "top_merchants")
    cal = dim_dates.select(
        F.col("date_key").alias(DATE),
        F.col("calendar_date").alias("transaction_date"),
        F.col("year").alias("transaction_year"),
        F.col("month").alias("transaction_month"),
        F.col("month_name").alias("transaction_month_name"),
        F.col("day_of_month").alias("transaction_day"),
        F.col("day_name").alias("transaction_day_name"),
        "is_weekend", "quarter", "year_month")
    # plain equi-joins on the day: a NULL day keeps its totals but, as in the
    # reference's `date_key = date_key` joins, gets zero status counts and no
    # top merchants
    out = join_days(daily_totals(fact_txn), DATE, cal, top)
    known = F.col(DATE).isNotNull()
    return out.select(
        DATE, "transaction_date", "transaction_year", "transaction_month", "transaction_month_name",
        "transaction_day", "transaction_day_name", "is_weekend", "quarter", "year_month",
        "transaction_count", "customer_count", "merchant_count", "total_amount", "avg_amount",
        "min_amount", "max_amount", "currencies",
        *[F.when(known, F.col(f"{s}_{m}")).otherwise(F.lit(0).cast("bigint") if m == "count" else F.lit(0.0))
          .alias(f"{s}_{m}") for s in schemas.TRANSACTION_STATUSES for m in ("count", "amount")],
        F.coalesce(F.col("top_merchants"), F.array()).alias("top_merchants"),
        ctx.updated_at_col.alias("dbt_updated_at"),
    )
