"""Facts S6-S11: key lookups and the installment roll-up.

Dimension lookups are plain left equi-joins with no hint.  Spark broadcasts
the dimension only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (statically from file sizes, and
again at runtime under AQE from the real shuffle size); a large customer
dimension falls back to a shuffle join, where AQE splits a skewed key
(a hot merchant, or the NULL key of anonymous events).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylater.context import RunContext
from paylater.functions import day_diff, ratio, surrogate_key
from paylater.functions.money import MONEY


# Prefix of the stand-in join key given to NULL keys; the extra join
# condition keeps such rows from matching anything.
NULL_SPREAD_PREFIX = "\u0000null:"


def lookup(fact: DataFrame, dim: DataFrame, key: str, cols: list[str],
           spread_nulls_by: str | None = None) -> DataFrame:
    """Left join ``dim[key, *cols]`` onto ``fact`` by natural key.

    Unmatched and NULL keys keep their fact row with NULL lookups.  The
    dimension is projected first, so only the key and the wanted columns
    are read or shuffled.

    In a shuffle join every NULL key hashes to the same partition; anonymous
    events are a fifth to a third of all events.  With ``spread_nulls_by``
    (a column of the fact) NULL keys are replaced, for partitioning only, by
    the hash of that
    column, and the join condition still requires a non-NULL key, so they
    never match.  The stand-in is a hash, so a retried task sends each row
    to the same partition.
    """
    d = dim.select(F.col(key).alias("_lookup_key"), *cols)
    if spread_nulls_by is None:
        cond = F.col(key) == d["_lookup_key"]
    else:
        stand_in = F.concat(F.lit(NULL_SPREAD_PREFIX),
                            F.xxhash64(spread_nulls_by).cast("string"))
        cond = (F.coalesce(F.col(key), stand_in) == d["_lookup_key"]) & F.col(key).isNotNull()
    return fact.join(d, cond, "left").drop("_lookup_key")


def lookup_key(fact: DataFrame, dim: DataFrame, key: str, sk_name: str,
               spread_nulls_by: str | None = None) -> DataFrame:
    """S6 for a hashed key: ``sk_name`` is ``surrogate_key(key)`` where ``key`` exists in ``dim``.

    The dimensions build their key as ``surrogate_key(natural key)``, so the
    lookup only needs to know whether (and how often) the natural key is in
    the dimension: the join carries the natural key and a flag instead of a
    32-character hash, about half the bytes to shuffle or broadcast.  A key
    present twice in the dimension still yields two fact rows, as a left
    join on the full dimension does.
    """
    found = dim.select(key, F.lit(True).alias("_found"))
    joined = lookup(fact, found, key, ["_found"], spread_nulls_by)
    return joined.withColumn(sk_name, F.when(F.col("_found"), surrogate_key(key))).drop("_found")


def fact_transactions(stg_transactions: DataFrame, dim_customers: DataFrame,
                      dim_merchants: DataFrame, ctx: RunContext) -> DataFrame:
    """One row per staged transaction with customer/merchant keys and a date key."""
    t = lookup_key(stg_transactions, dim_customers, "customer_id", "customer_sk",
                   spread_nulls_by="transaction_id")
    t = lookup_key(t, dim_merchants, "merchant_id", "merchant_sk", spread_nulls_by="transaction_id")
    return t.select(
        surrogate_key("transaction_id").alias("transaction_sk"),
        "transaction_id", "customer_sk", "merchant_sk",
        F.col("transaction_date").cast("date").alias("transaction_date_key"),
        "transaction_date", "amount", "currency", "payment_method", "status",
        F.col("_etl_extracted_at").alias("source_extracted_at"),
        ctx.updated_at_col.alias("dbt_updated_at"),
    )


def plan_installment_metrics(stg_installments: DataFrame) -> DataFrame:
    """Per plan, distinct installments (total / paid / defaulted), paid amount, mean days late.

    Distinct counts are taken in two steps instead of one ``Expand`` per
    conditional distinct: rows are first reduced to one per
    ``(plan_id, installment_id)`` with flags and partial sums, then summed
    per plan.  Both steps aggregate map-side before their shuffle, so even a
    (corrupt) plan id holding a third of all rows reaches the final step as
    one partial row per task.
    """
    st = F.col("status")
    is_paid = st.isin("paid", "paid_late")
    late = ((st == "paid_late") & F.col("due_date").isNotNull() & F.col("paid_date").isNotNull())
    per_installment = (
        stg_installments
        .groupBy("plan_id", "installment_id")
        .agg(
            F.max(is_paid.cast("int")).alias("_paid"),
            F.max((st == "defaulted").cast("int")).alias("_defaulted"),
            F.sum(F.when(is_paid, F.col("amount").cast(MONEY)).otherwise(F.lit(0).cast(MONEY)))
            .alias("_paid_amount"),
            F.sum(F.when(late, day_diff("due_date", "paid_date"))).alias("_late_days"),
            F.count(F.when(late, F.lit(1))).alias("_late_n"),
        )
    )
    # NULL installment ids count in the sums but not in the distinct counts.
    has_id = F.col("installment_id").isNotNull()
    zero = F.lit(0).cast("bigint")
    return per_installment.groupBy("plan_id").agg(
        F.count("installment_id").alias("total_installments"),
        F.coalesce(F.sum(F.when(has_id, F.col("_paid"))).cast("bigint"), zero)
        .alias("paid_installments"),
        F.coalesce(F.sum(F.when(has_id, F.col("_defaulted"))).cast("bigint"), zero)
        .alias("defaulted_installments"),
        F.sum("_paid_amount").cast("double").alias("total_paid_amount"),
        ratio(F.sum("_late_days"), F.sum("_late_n")).alias("avg_days_late"),
    )


def fact_payment_plans(stg_payment_plans: DataFrame, stg_installments: DataFrame,
                       dim_customers: DataFrame, dim_merchants: DataFrame,
                       fact_txn: DataFrame, ctx: RunContext) -> DataFrame:
    """S8 + S10: plan keys, installment metrics (zero when absent), completion rate.

    The roll-up is joined first: it comes out partitioned by ``plan_id``,
    so that join shuffles only the plans.  The transaction lookup is the
    one join of two large tables; it carries only transaction ids and a
    flag (``fact_transactions.transaction_sk`` is the surrogate of its id).
    """
    metrics = plan_installment_metrics(stg_installments)
    p = stg_payment_plans.join(metrics, on="plan_id", how="left")
    p = lookup_key(p, fact_txn, "transaction_id", "transaction_sk", spread_nulls_by="plan_id")
    return _plan_facts(p, dim_customers, dim_merchants, ctx)


def fact_payment_plans_bucketed(plans_by_transaction: DataFrame, transaction_ids: DataFrame,
                                stg_payment_plans: DataFrame, stg_installments: DataFrame,
                                dim_customers: DataFrame, dim_merchants: DataFrame, ctx: RunContext) -> DataFrame:
    """S8 + S10 over tables bucketed alike by ``transaction_id`` (``sources.bucketed``).

    The transaction lookup comes first, while both sides still lie in their buckets: no row of either is
    shuffled for it.  Plans without a transaction id are in no bucket; they come from ``stg_payment_plans``.
    One transaction that holds a large part of the plans makes one long bucket, which a task reads as a stream.
    """
    found = lookup_key(plans_by_transaction, transaction_ids, "transaction_id", "transaction_sk")
    without = (stg_payment_plans.where(F.col("transaction_id").isNull())
               .withColumn("transaction_sk", F.lit(None).cast("string")))
    p = found.unionByName(without).join(plan_installment_metrics(stg_installments), on="plan_id", how="left")
    return _plan_facts(p, dim_customers, dim_merchants, ctx)


def _plan_facts(p: DataFrame, dim_customers: DataFrame, dim_merchants: DataFrame, ctx: RunContext) -> DataFrame:
    """Columns of S10 from plans with their installment metrics and ``transaction_sk``."""
    p = lookup_key(p, dim_customers, "customer_id", "customer_sk", spread_nulls_by="plan_id")
    p = lookup_key(p, dim_merchants, "merchant_id", "merchant_sk", spread_nulls_by="plan_id")
    zero = F.lit(0).cast("bigint")
    paid_amount = F.coalesce(F.col("total_paid_amount"), F.lit(0.0))
    return p.select(
        surrogate_key("plan_id").alias("plan_sk"),
        "plan_id", "transaction_sk", "customer_sk", "merchant_sk",
        F.col("plan_date").cast("date").alias("plan_date_key"),
        "plan_date", "total_amount", "installment_count", "first_installment_amount", "status",
        F.coalesce("total_installments", zero).alias("total_installments"),
        F.coalesce("paid_installments", zero).alias("paid_installments"),
        F.coalesce("defaulted_installments", zero).alias("defaulted_installments"),
        paid_amount.alias("total_paid_amount"),
        "avg_days_late",
        F.when(F.col("total_amount") > 0, paid_amount / F.col("total_amount"))
        .alias("payment_completion_rate"),
        F.col("_etl_extracted_at").alias("source_extracted_at"),
        ctx.updated_at_col.alias("dbt_updated_at"),
    )


def fact_customer_events(stg_user_events: DataFrame, dim_customers: DataFrame,
                         dim_merchants: DataFrame, ctx: RunContext) -> DataFrame:
    """Events with customer/merchant keys; anonymous events keep NULL keys."""
    e = lookup_key(stg_user_events, dim_customers, "customer_id", "customer_sk", spread_nulls_by="event_id")
    e = lookup_key(e, dim_merchants, "merchant_id", "merchant_sk", spread_nulls_by="event_id")
    return e.select(
        surrogate_key("event_id").alias("event_sk"),
        "event_id", "customer_sk", "merchant_sk",
        F.col("event_timestamp").cast("date").alias("event_date_key"),
        "event_timestamp", "event_type", "platform", "session_id", "device_type", "country",
        F.col("_etl_extracted_at").alias("source_extracted_at"),
        ctx.updated_at_col.alias("dbt_updated_at"),
    )
