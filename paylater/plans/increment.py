"""Incremental refresh: new source rows carried through bronze, silver and gold.

Silver and gold end up equal to a full refresh over all rows (but for the run stamps), while only what the new
rows touch is computed and written:

- *Days.*  A fact's day is touched by its new rows, and by held rows whose lookups change: rows of new customers
  and merchants that had no match so far; for plans, also new installments and new transactions.  Touched days of a
  fact are written by dynamic partition overwrite; folders of other days keep their files.
- *Customers and merchants.*  Their metrics are computed again for those that any new row
  names.  The others keep their metrics; columns that depend on the run date are derived anew for all,
  and the sales of the last 30 days are read from the folders of these days.
- *Daily marts.*  Rows of touched days (and of days that enter the calendar) are computed, the others are kept.

New rows first go to ``increments/pending``; it is deleted when all layers are written.  A run that broke off
is finished by the next one, from these rows, before anything else is loaded; every step can be repeated.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paylater import schemas
from paylater.context import RunContext
from paylater.functions import surrogate_key
from paylater.operators import dims, facts, incremental
from paylater.operators.staging import stage
from paylater.plans import customer, merchant, payments, transactions
from paylater.plans.warehouse import FACT_DATES, GOLD_TABLES, Publication, read_silver, table_schemas, write_by_day
from paylater.sources import bronze
from paylater.sources.bronze import _files

KEYS = {"customers": "customer_id", "merchants": "merchant_id", "transactions": "transaction_id",
        "payment_plans": "plan_id", "installments": "installment_id", "user_events": "event_id"}
TIMES = {"transactions": "transaction_date", "user_events": "event_timestamp", "payment_plans": "plan_date"}
READY = "_READY"

Day = dt.date | None


def new_source_rows(spark: SparkSession, sources: dict[str, DataFrame], root: str, ctx: RunContext
                    ) -> dict[str, DataFrame]:
    """Rows with lineage that the bronze tables lack, each once (see ``incremental.new_rows``).

    Tables with an event time compare over the incoming rows' time span only, the others with all keys.
    """
    out = {}
    for table, rows in sources.items():
        columns = schemas.SOURCE_SCHEMAS[table].fieldNames()
        incoming = bronze.add_lineage(rows.select(*columns), table, ctx)
        held = spark.read.schema(incoming.schema).parquet(f"{root}/bronze/{table}")
        out[table] = incremental.new_rows(incoming, held, [KEYS[table]], columns, TIMES.get(table))
    return out


def _append(rows: DataFrame, path: str) -> int:
    """Appends rows to a table and counts them on the way."""
    seen = Observation()
    incremental.append(rows.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def append_new(spark: SparkSession, sources: dict[str, DataFrame], target: str, ctx: RunContext) -> dict[str, int]:
    """Source rows that the bronze tables under ``target`` lack, appended to them; their number by table.

    A repeated run appends nothing, whether rows have a key or not.
    """
    root = target.rstrip("/")
    return {t: _append(rows, f"{root}/bronze/{t}")
            for t, rows in new_source_rows(spark, sources, root, ctx).items()}


def append_pending(spark: SparkSession, root: str) -> dict[str, int]:
    """Appends the pending rows that bronze lacks (none twice, if a run broke off); the numbers appended."""
    added = {}
    for table, schema in schemas.SOURCE_SCHEMAS.items():
        pending, path = _pending(spark, root, table), f"{root}/bronze/{table}"
        held = spark.read.schema(pending.schema).parquet(path)
        added[table] = _append(incremental.new_rows(pending, held, [KEYS[table]], schema.fieldNames(),
                                                    TIMES.get(table)), path)
    return added


def _pending(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema = bronze.add_lineage(spark.createDataFrame([], schemas.SOURCE_SCHEMAS[table]), table,
                                RunContext(as_of=dt.date(2000, 1, 1))).schema
    return spark.read.schema(schema).parquet(f"{root}/increments/pending/{table}")


def _write_pending(spark: SparkSession, new: dict[str, DataFrame], root: str) -> None:
    for table, rows in new.items():
        rows.write.mode("overwrite").parquet(f"{root}/increments/pending/{table}")
    fs, make = _files(spark, root)
    fs.create(make(f"{root}/increments/pending/{READY}")).close()


# ---------------------------------------------------------------- what new rows touch

@dataclass
class Touched:
    """Days of each fact, and the keys of customers and merchants, that new rows change."""

    days: dict[str, list[Day]]
    customers: DataFrame            # customer_sk
    merchants: DataFrame            # merchant_sk


def _ids(*frames_and_columns: tuple[DataFrame, str]) -> DataFrame:
    """Distinct non-NULL values of some columns, as ``id``."""
    out = None
    for df, column in frames_and_columns:
        part = df.select(F.col(column).alias("id")).where("id is not null")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def _holding(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is one of ``ids``."""
    return df.join(ids.withColumnRenamed("id", column), column, "left_semi")


def touched(stg: dict[str, DataFrame], new: dict[str, DataFrame]) -> Touched:
    """``stg``: staged bronze tables, new rows included; ``new``: the new rows."""
    customers, merchants = _ids((new["customers"], "customer_id")), _ids((new["merchants"], "merchant_id"))
    plans = stg["payment_plans"]
    held = {
        "transactions": [], "user_events": [],
        "payment_plans": [_holding(plans, "plan_id", _ids((new["installments"], "plan_id"))),
                          _holding(plans, "transaction_id", _ids((new["transactions"], "transaction_id")))]}
    days, named = {}, []
    for table, fact in (("transactions", "fact_transactions"), ("payment_plans", "fact_payment_plans"),
                        ("user_events", "fact_customer_events")):
        rows = new[table]
        for part in (_holding(stg[table], "customer_id", customers), _holding(stg[table], "merchant_id", merchants),
                     *held[table]):
            rows = rows.select("customer_id", "merchant_id", TIMES[table]).unionByName(
                part.select("customer_id", "merchant_id", TIMES[table]))
        # as many as there are days
        days[fact] = [r.day for r in rows.select(F.col(TIMES[table]).cast("date").alias("day")).distinct().collect()]
        named.append(rows)

    def keys(column: str, own: DataFrame) -> DataFrame:
        return _ids(*[(df, column) for df in named], (own, column)).select(
            surrogate_key("id").alias(column.replace("_id", "_sk")))

    return Touched(days, keys("customer_id", new["customers"]), keys("merchant_id", new["merchants"]))


def on_days(column: str | Column, days: list[Day]) -> Column:
    """Rows of some days; None stands for rows without a day."""
    c = F.col(column) if isinstance(column, str) else column
    known = [d for d in days if d is not None]
    held = c.isin(known) if known else F.lit(False)
    return F.coalesce(held, F.lit(False)) | c.isNull() if None in days else F.coalesce(held, F.lit(False))


def _rows_on(stg: DataFrame, time: str, days: list[Day]) -> DataFrame:
    """Staged rows of some days; the span of the days is a predicate that reaches the Parquet scan."""
    known = sorted(d for d in days if d is not None)
    rows = stg.where(on_days(F.col(time).cast("date"), days))
    if known and None not in days:
        low, high = (F.to_timestamp_ntz(F.lit(d.isoformat())) for d in (known[0], known[-1] + dt.timedelta(days=1)))
        rows = rows.where((F.col(time) >= low) & (F.col(time) < high))
    return rows


# ---------------------------------------------------------------- silver and gold

def update_silver(spark: SparkSession, root: str, stg: dict[str, DataFrame], change: Touched, ctx: RunContext) -> None:
    """Dimensions anew, and the touched days of the facts."""
    layer = Publication(spark, f"{root}/silver")
    dc = layer.write("dim_customers", dims.dim_customers(stg["customers"], ctx))
    dm = layer.write("dim_merchants", dims.dim_merchants(stg["merchants"], ctx))
    layer.write("dim_dates", dims.dim_dates(spark, ctx))
    days = change.days

    def put(fact: str, rows: DataFrame) -> None:
        write_by_day(rows, f"{root}/silver/{fact}", FACT_DATES[fact], only_days=True)

    if days["fact_transactions"]:
        rows = _rows_on(stg["transactions"], "transaction_date", days["fact_transactions"])
        put("fact_transactions", facts.fact_transactions(rows, dc, dm, ctx))
    if days["fact_payment_plans"]:
        plans = _rows_on(stg["payment_plans"], "plan_date", days["fact_payment_plans"])
        # of the two large tables only the rows of these plans take part
        paid = _holding(stg["installments"], "plan_id", _ids((plans, "plan_id")))
        stored = read_silver(spark, root, ctx).fact_transactions.select("transaction_id")
        sold = _holding(stored, "transaction_id", _ids((plans, "transaction_id")))
        put("fact_payment_plans", facts.fact_payment_plans(plans, paid, dc, dm, sold, ctx))
    if days["fact_customer_events"]:
        rows = _rows_on(stg["user_events"], "event_timestamp", days["fact_customer_events"])
        put("fact_customer_events", facts.fact_customer_events(rows, dc, dm, ctx))
    layer.publish()


def _of(df: DataFrame, key: str, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    return df.join(keys, key, how)


def update_gold(spark: SparkSession, root: str, change: Touched, ctx: RunContext, new_days: list[Day]) -> None:
    """The four marts from their last versions and the touched days, customers and merchants.

    ``new_days``: days that the calendar did not hold before.
    """
    s, known = read_silver(spark, root, ctx), table_schemas(spark, ctx)
    held = {t: spark.read.schema(known[t]).parquet(f"{root}/gold/{t}") for t in GOLD_TABLES}
    layer = Publication(spark, f"{root}/gold")

    for name, fact, build in (
            ("gold_transaction_analytics", "fact_transactions", transactions.gold_transaction_analytics),
            ("gold_payment_analytics", "fact_payment_plans", payments.gold_payment_analytics)):
        date = FACT_DATES[fact]
        days = list({*change.days[fact], *new_days})
        here = on_days(date, days)
        rows = build(getattr(s, fact).where(here), s.dim_merchants, s.dim_dates, ctx)
        layer.write(name, held[name].where(~here).unionByName(rows))

    facts_of = lambda key, keys: [_of(f, key, keys) for f in (                                # noqa: E731
        s.fact_transactions, s.fact_payment_plans, s.fact_customer_events)]
    c, m = change.customers, change.merchants
    again = customer.with_metrics(_of(s.dim_customers, "customer_sk", c), *facts_of("customer_sk", c))
    kept = customer.held_metrics(held["gold_customer_analytics"], _of(s.dim_customers, "customer_sk", c, "left_anti"))
    layer.write("gold_customer_analytics", customer.from_metrics(again.unionByName(kept), ctx))

    again = merchant.with_metrics(_of(s.dim_merchants, "merchant_sk", m), *facts_of("merchant_sk", m), ctx)
    kept = merchant.held_metrics(held["gold_merchant_analytics"], _of(s.dim_merchants, "merchant_sk", m, "left_anti"),
                                 s.fact_transactions, ctx)
    layer.write("gold_merchant_analytics", merchant.from_metrics(again.unionByName(kept), ctx))
    layer.publish()


def _finish(spark: SparkSession, root: str, ctx: RunContext) -> dict[str, int]:
    """Carries the pending rows through all layers, and forgets them."""
    added = append_pending(spark, root)
    new = {t: _pending(spark, root, t) for t in schemas.SOURCE_SCHEMAS}
    stg = {t: stage(spark.read.schema(df.schema).parquet(f"{root}/bronze/{t}"), t) for t, df in new.items()}
    change = touched(stg, new)
    fs, make = _files(spark, root)
    calendar = f"{root}/increments/pending/calendar"
    if not fs.exists(make(f"{calendar}/_SUCCESS")):        # the calendar before this increment, also for a repeat
        bronze.restore_folder(spark, f"{root}/silver/dim_dates")
        spark.read.parquet(f"{root}/silver/dim_dates").select("date_key").write.mode("overwrite").parquet(calendar)
    update_silver(spark, root, stg, change, ctx)
    before = spark.read.schema("date_key date").parquet(calendar)
    dates = spark.read.parquet(f"{root}/silver/dim_dates").select("date_key")
    # both ways: the calendar may also begin later than it did; as many as the calendar has days
    moved = [r.date_key for r in dates.exceptAll(before).unionByName(before.exceptAll(dates)).collect()]
    update_gold(spark, root, change, ctx, moved)
    fs.delete(make(f"{root}/increments/pending"), True)
    return added


def increment(spark: SparkSession, sources: dict[str, DataFrame], target: str, ctx: RunContext) -> dict[str, int]:
    """Loads the source rows that the warehouse under ``target`` lacks into all its layers; their number by table.

    The warehouse was built by ``jobs.refresh`` with facts by day.  Rows are told apart by key (see
    ``incremental.new_rows``); rows that are held already are not changed.
    """
    root = target.rstrip("/")
    fs, make = _files(spark, root)
    if fs.exists(make(f"{root}/increments/pending/{READY}")):
        _finish(spark, root, ctx)
    fs.delete(make(f"{root}/increments/pending"), True)
    _write_pending(spark, new_source_rows(spark, sources, root, ctx), root)
    return _finish(spark, root, ctx)
