"""Daily payment-plan mart F1-F8."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylater.functions import ratio
from paylater.functions.distinct import join_days, multi_counts
from paylater.functions.money import MONEY
from paylater.operators.topk import top_k_with_lookup

DATE = "plan_date_key"
TOP_K = 5
MIN_PLANS = 5  # merchants need this many plans that day to rank by default rate
PLAN_STATUS_FLAGS = {"active_plans": "active", "completed_plans": "completed",
                     "defaulted_plans": "defaulted"}


def daily_payment_plans(fact_plans: DataFrame) -> DataFrame:
    """F1 + F2: plans per day, from one scan (see ``multi_counts``)."""
    amount, st = F.col("total_amount"), F.col("status")
    out = multi_counts(
        fact_plans, [DATE],
        {"plan_count": "plan_sk", "customer_count": "customer_sk", "merchant_count": "merchant_sk"},
        flags={name: ("plan_count", st == s) for name, s in PLAN_STATUS_FLAGS.items()},
        partials={
            "_amount_sum": (amount.cast(MONEY), "sum"), "_amount_n": (amount, "count"),
            "_inst_sum": (F.col("installment_count"), "sum"), "_inst_n": (F.col("installment_count"), "count"),
            # rate times amount is the paid amount: a sum of cents, which is exact
            "_weighted": ((F.col("payment_completion_rate") * amount).cast(MONEY), "sum"),
        })
    total = F.col("_amount_sum").cast("double")
    return out.select(
        DATE, "plan_count", "customer_count", "merchant_count",
        total.alias("total_amount"),
        ratio(total, F.col("_amount_n")).alias("avg_plan_amount"),
        ratio(F.col("_inst_sum"), F.col("_inst_n")).alias("avg_installment_count"),
        *PLAN_STATUS_FLAGS,
        ratio(F.col("_weighted").cast("double"), total).alias("weighted_completion_rate"),
    )


def merchant_daily_plans(fact_plans: DataFrame) -> DataFrame:
    """per merchant and day, with default rate (NULL group kept)."""
    out = multi_counts(
        fact_plans, ["merchant_sk", DATE], {"plan_count": "plan_sk", "customer_count": "customer_sk"},
        flags={"defaulted_plans": ("plan_count", F.col("status") == "defaulted")},
        partials={"_amount_sum": (F.col("total_amount").cast(MONEY), "sum"),
                  "_amount_n": (F.col("total_amount"), "count")})
    total = F.col("_amount_sum").cast("double")
    return out.select(
        "merchant_sk", DATE, "plan_count", "customer_count",
        total.alias("total_amount"),
        ratio(total, F.col("_amount_n")).alias("avg_plan_amount"),
        "defaulted_plans",
        ratio(F.col("defaulted_plans"), F.col("plan_count")).alias("default_rate"),
    )


def default_order():
    """Highest default rate first; ties by merchant key (NULL last)."""
    return [F.col("default_rate").desc_nulls_last(), F.col("merchant_sk").asc_nulls_last()]


def volume_order():
    """Largest plan amount first; ties by merchant key (NULL last)."""
    return [F.col("total_amount").desc_nulls_last(), F.col("merchant_sk").asc_nulls_last()]


DEFAULT_PAYLOAD = ["merchant_sk", "merchant_name", "plan_count", "defaulted_plans", "default_rate"]
VOLUME_PAYLOAD = ["merchant_sk", "merchant_name", "plan_count", "total_amount"]


def _top(mp: DataFrame, dim_merchants: DataFrame, order: list, payload: list[str], k: int,
         rank_col: str = "rank") -> DataFrame:
    """Top-k merchants per day of ``mp``; names are looked up for the top rows only."""
    return top_k_with_lookup(mp, [DATE], order, k, [c for c in payload if c != "merchant_name"],
                             dim_merchants, "merchant_sk", ["merchant_name"], payload, rank_col)


def daily_top_defaulters(fact_plans: DataFrame, dim_merchants: DataFrame, k: int = TOP_K,
                         min_plans: int = MIN_PLANS) -> DataFrame:
    """F5 as rows: merchants with at least ``min_plans`` plans that day, by default rate."""
    mp = merchant_daily_plans(fact_plans).where(F.col("plan_count") >= min_plans)
    return _top(mp, dim_merchants, default_order(), DEFAULT_PAYLOAD, k)


def daily_top_plan_merchants(fact_plans: DataFrame, dim_merchants: DataFrame,
                             k: int = TOP_K) -> DataFrame:
    """F6 as rows: merchants by plan amount that day."""
    return _top(merchant_daily_plans(fact_plans), dim_merchants, volume_order(), VOLUME_PAYLOAD, k)


def daily_top_lists(mp: DataFrame, dim_merchants: DataFrame, k: int = TOP_K, min_plans: int = MIN_PLANS) -> DataFrame:
    """F5 and F6 as lists, one row per day, from one pass over the merchants of a day (``mp``, F3).

    Both orders are ranked over the same rows, names are looked up for the rows that either
    order keeps, and these are ranked again (a merchant that the dimension repeats takes two places).
    """
    eligible = F.col("plan_count") >= min_plans

    def ranked(df: DataFrame, more: list) -> DataFrame:
        day = Window.partitionBy(DATE)
        # merchants below the least number of plans come last and are not kept
        by_default = day.orderBy(F.when(eligible, 0).otherwise(1), *default_order(), *more)
        return df.withColumns({
            "_d": F.when(eligible, F.row_number().over(by_default)),
            "_v": F.row_number().over(day.orderBy(*volume_order(), *more)),
        }).where((F.col("_d") <= k) | (F.col("_v") <= k))

    first = ranked(mp.select(DATE, "merchant_sk", "plan_count", "defaulted_plans", "default_rate", "total_amount"), [])
    named = first.drop("_d", "_v").join(dim_merchants.select("merchant_sk", "merchant_name"), "merchant_sk", "left")
    last = ranked(named, [F.col("merchant_name").asc_nulls_last()])

    def listed(rank: str, payload: list[str], out: str):
        kept = F.collect_list(F.when(F.col(rank) <= k, F.struct(rank, *payload)))
        return F.transform(F.sort_array(kept), lambda s: s.dropFields(rank)).alias(out)

    return last.groupBy(DATE).agg(listed("_d", DEFAULT_PAYLOAD, "top_defaulting_merchants"),
                                  listed("_v", VOLUME_PAYLOAD, "top_merchants_by_volume"))


def gold_payment_analytics(fact_plans: DataFrame, dim_merchants: DataFrame, dim_dates: DataFrame,
                           ctx, k: int = TOP_K, min_plans: int = MIN_PLANS) -> DataFrame:
    """F8: daily plan metrics, default rate, calendar and the two top-k arrays; two scans of the fact."""
    tops = daily_top_lists(merchant_daily_plans(fact_plans), dim_merchants, k, min_plans)
    cal = dim_dates.select(
        F.col("date_key").alias(DATE), F.col("calendar_date").alias("plan_date"),
        F.col("year").alias("plan_year"), F.col("month").alias("plan_month"),
        F.col("month_name").alias("plan_month_name"), F.col("quarter").alias("plan_quarter"),
        F.col("year_month").alias("plan_year_month"))
    # plain equi-joins on the day: a NULL day gets empty top-k arrays, as the
    # reference's correlated `date_key = date_key` subqueries give
    out = join_days(daily_payment_plans(fact_plans), DATE, cal, tops)
    return out.select(
        DATE, "plan_date", "plan_year", "plan_month", "plan_month_name", "plan_quarter",
        "plan_year_month", "plan_count", "customer_count", "merchant_count", "total_amount",
        "avg_plan_amount", "avg_installment_count", "active_plans", "completed_plans",
        "defaulted_plans", "weighted_completion_rate",
        ratio(F.col("defaulted_plans"), F.col("plan_count")).alias("default_rate"),
        F.coalesce(F.col("top_defaulting_merchants"), F.array()).alias("top_defaulting_merchants"),
        F.coalesce(F.col("top_merchants_by_volume"), F.array()).alias("top_merchants_by_volume"),
        ctx.updated_at_col.alias("dbt_updated_at"),
    )
