"""Installment schedule (S12) and installment status rule.

S12 expands a payment plan into its ``installment_count`` installments:
number ``j`` (1-based), an equal share of the total rounded half-up to the
cent, and a due date ``j - 1`` months after the plan date (clamped to the
month end, time of day kept).

S13 decides what happened to an installment by ``as_of``: not yet due ->
``scheduled``; otherwise a draw in ``[0, 100)`` picks ``defaulted``,
``paid_late`` (paid 1-30 days after the due date) or ``paid`` (0-5 days
early).  The draw is a column the caller provides, so the rule is
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylater.context import RunContext

# Fixed values of the status rule: cut points on a 0-99 draw and day ranges.
DEFAULT_CUT = 95        # draw >= 95 -> defaulted
LATE_CUT = 85           # draw >= 85 -> paid_late
MAX_DAYS_LATE = 30      # paid 1..30 days late
MAX_DAYS_EARLY = 5      # paid 0..5 days early


def installment_schedule(plans: DataFrame, extra_cols: list[str] | None = None) -> DataFrame:
    """One row per installment: plan_id, installment_id, installment_number, amount, due_date.

    Needs ``plan_id``, ``plan_date``, ``total_amount``, ``installment_count``.
    The expansion is a narrow ``explode``: no shuffle, and each output row
    depends on one plan row only.
    """
    extra = extra_cols or []
    n = F.col("installment_count")
    cents = F.round(F.col("total_amount") * 100).cast("bigint")
    # half-up rounding of cents / n in integer arithmetic
    share_cents = F.when(n >= 1, F.floor((cents * 2 + n) / (n * 2)).cast("bigint"))
    exploded = plans.select(
        "plan_id", "plan_date", "installment_count", *extra,
        share_cents.alias("_share_cents"),
        # no rows for a count below 1 (sequence(1, 0) would count down)
        F.explode(F.when(n >= 1, F.sequence(F.lit(1).cast("bigint"), n.cast("bigint")))
                  .otherwise(F.array().cast("array<bigint>"))).alias("installment_number"),
    )
    return exploded.select(
        F.concat(F.regexp_replace("plan_id", "^PLAN", "INST"), F.lit("_"),
                 F.col("installment_number").cast("string")).alias("installment_id"),
        "plan_id",
        "installment_number",
        (F.col("_share_cents") / F.lit(100.0)).alias("amount"),
        (F.col("plan_date") + F.make_interval(F.lit(0), (F.col("installment_number") - 1).cast("int")))
        .alias("due_date"),
        *extra,
    )


def installment_status(installments: DataFrame, ctx: RunContext, draw: Column) -> DataFrame:
    """Add ``status`` and ``paid_date`` from ``due_date``, ``as_of`` and a 0-99 ``draw``."""
    due = F.col("due_date")
    h = draw.cast("bigint")
    not_due = due > ctx.as_of_ts
    status = (F.when(not_due, "scheduled")
              .when(h >= DEFAULT_CUT, "defaulted")
              .when(h >= LATE_CUT, "paid_late")
              .otherwise("paid"))
    late_days = (F.lit(1) + h % MAX_DAYS_LATE).cast("int")
    early_days = (h % (MAX_DAYS_EARLY + 1)).cast("int")
    paid = (F.when(not_due, F.lit(None))
            .when(h >= DEFAULT_CUT, F.lit(None))
            .when(h >= LATE_CUT, due + F.make_interval(F.lit(0), F.lit(0), F.lit(0), late_days))
            .otherwise(due - F.make_interval(F.lit(0), F.lit(0), F.lit(0), early_days)))
    return installments.withColumns({"paid_date": paid.cast("timestamp_ntz"), "status": status})
