"""Dimensions S2-S5: customers, merchants and the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylater.context import RunContext
from paylater.functions import day_diff, day_of_week0, surrogate_key, text_null_concat

def dim_customers(stg_customers: DataFrame, ctx: RunContext) -> DataFrame:
    """Hashed key, source columns, ``full_name`` (NULL parts as empty text)."""
    return stg_customers.select(
        surrogate_key("customer_id").alias("customer_sk"),
        "customer_id", "email", "first_name", "last_name", "phone_number",
        "country", "city", "registration_date", "last_login_date", "status",
        text_null_concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        F.col("_etl_extracted_at").alias("source_extracted_at"),
        ctx.updated_at_col.alias("dbt_updated_at"),
    )


def dim_merchants(stg_merchants: DataFrame, ctx: RunContext) -> DataFrame:
    """S3: hashed key, source columns, days since onboarding at ``as_of``."""
    return stg_merchants.select(
        surrogate_key("merchant_id").alias("merchant_sk"),
        "merchant_id", "merchant_name", "category", "country",
        "integration_type", "onboarding_date", "status",
        day_diff("onboarding_date", ctx.as_of_col).alias("days_since_onboarding"),
        F.col("_etl_extracted_at").alias("source_extracted_at"),
        ctx.updated_at_col.alias("dbt_updated_at"),
    )


def date_spine(spark: SparkSession, start: dt.date, end_exclusive: dt.date) -> DataFrame:
    """One row per day in ``[start, end_exclusive)``, column ``date_day``.

    The row count is bounded by the two parameters, not by any table, so the
    calendar is always small enough to broadcast.
    """
    last = end_exclusive - dt.timedelta(days=1)
    if last < start:   # an empty range has no days (sequence() would reject it)
        return spark.range(0).select(F.lit(start).alias("date_day"))
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def calendar_attributes(spine: DataFrame, ctx: RunContext) -> DataFrame:
    """Calendar attributes for each ``date_day``."""
    d = F.col("date_day")
    dow = day_of_week0(d)
    return spine.select(
        d.alias("date_key"),
        d.alias("calendar_date"),
        F.year(d).cast("bigint").alias("year"),
        F.month(d).cast("bigint").alias("month"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        (d == ctx.as_of_col).alias("is_current_day"),
        (d == F.trunc(d, "MM")).alias("is_first_day_of_month"),
        (d == F.last_day(d)).alias("is_last_day_of_month"),
        ctx.updated_at_col.alias("dbt_updated_at"),
    )


def dim_dates(spark: SparkSession, ctx: RunContext) -> DataFrame:
    """Calendar from ``ctx.calendar_start`` up to (excluding) ``as_of`` + 3 years."""
    return calendar_attributes(
        date_spine(spark, ctx.calendar_start, ctx.calendar_end_exclusive), ctx)
