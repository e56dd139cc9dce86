"""The six source tables, derived from the driver's test tables.

The reference ships no data; these frames stand in for its source system so
that every operator runs on real rows that grow with the scale factor.  Only
integer arithmetic is used, so an independent DuckDB statement of the same
mapping gives identical rows.  The mapping only shapes rows into the source
schemas; none of the warehouse's work happens here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylater import schemas
from paylater.context import TEST_CONTEXT, RunContext
from paylater.operators.schedule import installment_schedule, installment_status

# Fixed values of the mapping (see FIXTURES.md).
REGISTRATION_START = "1999-09-01"
REGISTRATION_SPAN_DAYS = 730
ONBOARDING_START = "1998-09-01"
ORDER_EPOCH = "1995-01-01"
TRANSACTION_LAST_DAY = "2001-08-01"
HOT_PRIORITY = "1-URGENT"
EVENT_SHIFT_DAYS = 8216      # event days from January 2024 to July 2001


def _pick(index: Column, values: list) -> Column:
    """``values[index]`` as a ``when`` chain."""
    out = None
    for i, v in enumerate(values):
        out = F.when(index == i, F.lit(v)) if out is None else out.when(index == i, F.lit(v))
    return out


def _ntz_day(start: str, days: Column) -> Column:
    return F.to_timestamp_ntz(F.date_add(F.lit(start).cast("date"), days.cast("int")))


def _padded(prefix: str, n: Column, width: int) -> Column:
    """Prefix and number, padded to a least width; longer numbers stay whole."""
    text = n.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text))


def _flawed(value: Column, key: Column, every: int, instead) -> Column:
    """``value``, but ``instead`` in one of ``every`` rows: flaws for the quality tests to find."""
    return F.when(key % every == every // 2, F.lit(instead)).otherwise(value)


# Column types of the driver's tables that the mapping reads.  Giving the
# schema skips Spark's footer-reading inference job on every read.
DRIVER_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    first = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
    last = F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))
    reg = _ntz_day(REGISTRATION_START, key % REGISTRATION_SPAN_DAYS)
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(
                _padded("CUST", key, 6).alias("customer_id"),
                F.concat(F.lower(first), last, F.lit("@example.com")).alias("email"),
                first.alias("first_name"),
                last.alias("last_name"),
                F.concat(F.lit("+"), key.cast("string")).alias("phone_number"),
                _flawed(_pick(F.col("c_nationkey") % 4, schemas.COUNTRIES), key, 401, "Oman").alias("country"),
                F.col("n_name").alias("city"),
                reg.alias("registration_date"),
                F.when(key % 5 != 0, reg + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(30)))
                .cast("timestamp_ntz").alias("last_login_date"),
                _flawed(F.when(key % 30 == 0, "inactive").when(key % 30 == 1, "suspended")
                        .otherwise("active"), key, 409, "blocked").alias("status"),
            ))


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    return s.select(
        _padded("MERCH", key, 4).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        _flawed(_pick(key % 8, schemas.MERCHANT_CATEGORIES), key, 41, "Other").alias("category"),
        _flawed(_pick(F.col("s_nationkey") % 4, schemas.COUNTRIES), key, 43, "Oman").alias("country"),
        _flawed(_pick(key % 3, schemas.INTEGRATION_TYPES), key, 47, "manual").alias("integration_type"),
        _ntz_day(ONBOARDING_START, (key * 37) % 1000).alias("onboarding_date"),
        _flawed(F.when(key % 20 == 0, "inactive").when(key % 20 == 1, "pending")
                .otherwise("active"), key, 37, "closed").alias("status"),
    )


def _orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a transaction, with the derived integer columns.

    Orders of every 50th customer never complete, so some customers have
    no purchases (the "No Purchases" segment and NULL purchase metrics).
    """
    o = _read(spark, sf_dir, "orders")
    li = (_read(spark, sf_dir, "lineitem").groupBy("l_orderkey")
          .agg(F.min("l_suppkey").alias("supp")))
    k = F.col("o_orderkey")
    age = F.datediff(F.col("o_orderdate").cast("date"), F.lit(ORDER_EPOCH).cast("date")) % 365
    day = F.date_sub(F.lit(TRANSACTION_LAST_DAY).cast("date"), age.cast("int"))
    ts = F.timestamp_add("SECOND", (k % 86400), F.to_timestamp_ntz(day))
    supp = F.col("supp")
    merchant = (F.when(F.col("o_orderpriority") == HOT_PRIORITY, F.lit(0).cast("bigint"))
                .when(supp.isNull() | (supp % 25 == 24), F.lit(None).cast("bigint"))
                .otherwise(supp))
    st = k % 100
    status = (F.when(F.col("o_custkey") % 50 == 49, "pending").when(st < 85, "completed").when(st < 90, "pending").when(st < 95, "failed")
              .when(st < 98, "cancelled").otherwise("refunded"))
    status = _flawed(status, k, 313, "unknown")
    cents = _flawed(F.floor(F.round(F.col("o_totalprice") * 100).cast("bigint") / 500).cast("bigint"), k, 311, 0)
    return (o.join(li, o.o_orderkey == li.l_orderkey, "left")
            .select(
                k.alias("o_orderkey"),
                cents.alias("cents"),
                _padded("TXN", k, 8).alias("transaction_id"),
                _flawed(_padded("CUST", F.col("o_custkey"), 6), k, 293, "CUST-GONE").alias("customer_id"),
                _flawed(F.when(merchant.isNotNull(), _padded("MERCH", merchant, 4)), k, 283,
                        "MERCH-GONE").alias("merchant_id"),
                ts.alias("transaction_date"),
                (cents / F.lit(100.0)).alias("amount"),
                _flawed(_pick(k % 4, schemas.CURRENCIES), k, 307, "XXX").alias("currency"),
                _flawed(_pick(k % 3, schemas.PAYMENT_METHODS), k, 317, "cash").alias("payment_method"),
                status.alias("status"),
            ))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_base(spark, sf_dir).select(*schemas.TRANSACTIONS.fieldNames())


def _plans_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every completed transaction as a plan of installments."""
    t = _orders_base(spark, sf_dir).where(F.col("status") == "completed")
    k = F.col("o_orderkey")
    n = _flawed(_pick(k % 3, schemas.INSTALLMENT_COUNTS), k, 331, 9).cast("bigint")
    share = F.floor((F.col("cents") * 2 + n) / (n * 2)).cast("bigint")
    return t.select(
        "o_orderkey",
        _padded("PLAN", k, 8).alias("plan_id"),
        _flawed(F.col("transaction_id"), k, 337, "TXN-GONE").alias("transaction_id"),
        "customer_id", "merchant_id",
        F.col("transaction_date").alias("plan_date"),
        F.col("amount").alias("total_amount"),
        n.alias("installment_count"),
        (share / F.lit(100.0)).alias("first_installment_amount"),
        _flawed(F.when(k % 40 == 0, "completed").when(k % 40 == 1, "defaulted")
                .otherwise("active"), k, 347, "paused").alias("status"),
    )


def payment_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plans_base(spark, sf_dir).select(*schemas.PAYMENT_PLANS.fieldNames())


def installments(spark: SparkSession, sf_dir: str, ctx: RunContext = TEST_CONTEXT) -> DataFrame:
    """The plans' schedules with statuses; some rows are delivered twice, some name no plan, some
    have a status of their own."""
    sched = installment_schedule(_plans_base(spark, sf_dir), extra_cols=["o_orderkey"])
    k = F.col("o_orderkey")
    draw = (k * 31 + F.col("installment_number") * 17) % 100
    rows = installment_status(sched, ctx, draw).withColumns({
        "status": _flawed(F.col("status"), k * 12 + F.col("installment_number"), 353, "lost"),
        "plan_id": _flawed(F.col("plan_id"), k, 359, "PLAN-GONE"),
        "copies": F.when((k % 367 == 183) & (F.col("installment_number") == 1), F.array(F.lit(1), F.lit(2)))
        .otherwise(F.array(F.lit(1)))})
    return rows.withColumn("copy", F.explode("copies")).select(*schemas.INSTALLMENTS.fieldNames())


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    eid = F.col("event_id")
    kind = F.col("event_type")
    etype = (F.when((kind == "click") & (eid % 3 == 0), "add_to_cart")
             .when(kind == "click", "product_view")
             .when(kind == "view", "app_open")
             .when(kind == "error", "search")
             .when(kind == "signup", "checkout")
             .when(kind == "purchase", "purchase"))
    ts = F.timestamp_add("DAY", F.lit(-EVENT_SHIFT_DAYS), F.col("ts")).cast("timestamp_ntz")
    merchant = F.when(eid % 2 == 0, F.floor(eid / 2) % 100).otherwise(eid % 5000)
    return e.select(
        eid.cast("string").alias("event_id"),
        ts.alias("event_timestamp"),
        F.when(eid % 5 != 0, _padded("CUST", F.col("user_id"), 6)).alias("customer_id"),
        _flawed(etype, eid, 373, "unknown").alias("event_type"),
        _flawed(_pick(eid % 3, schemas.PLATFORMS), eid, 379, "tv").alias("platform"),
        F.when(F.floor(eid / 10) % 10 >= 3, _padded("MERCH", merchant, 4)).alias("merchant_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), ts.cast("date").cast("string")).alias("session_id"),
        _flawed(_pick(eid % 3, schemas.DEVICE_TYPES), eid, 383, "watch").alias("device_type"),
        _flawed(_pick(eid % 4, schemas.COUNTRIES), eid, 389, "Oman").alias("country"),
    )


SOURCE_BUILDERS = {
    "customers": customers,
    "merchants": merchants,
    "transactions": transactions,
    "payment_plans": payment_plans,
    "installments": installments,
    "user_events": user_events,
}


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six source tables as lazy frames, in ``schemas.SOURCE_SCHEMAS`` column order."""
    return {name: build(spark, sf_dir) for name, build in SOURCE_BUILDERS.items()}

