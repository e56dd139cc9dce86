"""Bronze -> staging -> silver, lazily or materialised as Parquet.

``Warehouse`` builds each frame on first use only, so a query that needs
one fact does not analyse the others.  ``build_warehouse`` and ``build_gold``
write each layer once to a shared folder and re-read it, so the next layer
starts from short plans over Parquet files (the reference materialises
silver and gold as tables) and a lost executor recomputes from those files,
not from the sources.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylater.context import RunContext
from paylater.operators import dims, facts
from paylater.operators.staging import stage
from paylater.sources import fixtures
from paylater.sources.bronze import (BronzeLoadError, LoadReport, add_lineage, fresh_folder, load_table,
                                     publish_folder, restore_folder)
from paylater.sources.bucketed import bucketed
from paylater import schemas

SILVER_TABLES = ["dim_customers", "dim_merchants", "dim_dates",
                 "fact_transactions", "fact_payment_plans", "fact_customer_events"]


class _LazyTables(dict):
    """``dict`` of frames built on first lookup."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self._builders = builders

    def __missing__(self, key: str) -> DataFrame:
        df = self._builders[key]()
        self[key] = df
        return df

    def keys(self):  # all tables, built or not
        return self._builders.keys()

    def values(self):
        return [self[k] for k in self._builders]

    def items(self):
        return [(k, self[k]) for k in self._builders]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


class Silver:
    """The six silver tables; each built on first attribute access."""

    def __init__(self, spark: SparkSession, stg: dict[str, DataFrame], ctx: RunContext):
        self._spark, self._stg, self._ctx = spark, stg, ctx

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dims.dim_customers(self._stg["customers"], self._ctx)

    @cached_property
    def dim_merchants(self) -> DataFrame:
        return dims.dim_merchants(self._stg["merchants"], self._ctx)

    @cached_property
    def dim_dates(self) -> DataFrame:
        return dims.dim_dates(self._spark, self._ctx)

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return facts.fact_transactions(self._stg["transactions"], self.dim_customers,
                                       self.dim_merchants, self._ctx)

    @cached_property
    def fact_payment_plans(self) -> DataFrame:
        return facts.fact_payment_plans(self._stg["payment_plans"], self._stg["installments"],
                                        self.dim_customers, self.dim_merchants,
                                        self.fact_transactions, self._ctx)

    @cached_property
    def fact_customer_events(self) -> DataFrame:
        return facts.fact_customer_events(self._stg["user_events"], self.dim_customers,
                                          self.dim_merchants, self._ctx)


class StoredSilver:
    """Silver tables read back from Parquet files."""

    def __init__(self, frames: dict[str, DataFrame]):
        for k, v in frames.items():
            setattr(self, k, v)


class Warehouse:
    def __init__(self, spark: SparkSession, bronze: dict[str, DataFrame], ctx: RunContext):
        self.spark, self.ctx = spark, ctx
        self.bronze = bronze
        self.staging = _LazyTables({t: (lambda t=t: stage(self.bronze[t], t)) for t in bronze})
        self.silver = Silver(spark, self.staging, ctx)


def from_test_tables(spark: SparkSession, sf_dir: str, ctx: RunContext) -> Warehouse:
    """Lazy warehouse over the driver's tables (mapping in ``sources.fixtures``)."""
    def build(t: str) -> DataFrame:
        src = fixtures.SOURCE_BUILDERS[t](spark, sf_dir)
        return add_lineage(src.select(*schemas.SOURCE_SCHEMAS[t].fieldNames()), t, ctx)
    bronze = _LazyTables({t: (lambda t=t: build(t)) for t in fixtures.SOURCE_BUILDERS})
    return Warehouse(spark, bronze, ctx)


def from_bronze(spark: SparkSession, bronze: dict[str, DataFrame], ctx: RunContext) -> Warehouse:
    return Warehouse(spark, bronze, ctx)


class ParallelJobsError(RuntimeError):
    """Some of a set of independent jobs failed; the others ran to the end."""

    def __init__(self, done: dict, failed: dict[str, BaseException]):
        self.done, self.failed = done, failed
        super().__init__(f"failed: {sorted(failed)}: " +
                         "; ".join(f"{k}: {type(e).__name__}: {e}" for k, e in failed.items()))


def _run_parallel(tasks: dict[str, Callable[[], DataFrame]], workers: int) -> dict[str, DataFrame]:
    """Submit independent Spark jobs from a thread pool.

    Every job runs to the end even when another fails; failures are raised
    together afterwards (``ParallelJobsError``), never dropped.
    """
    done, failed = {}, {}
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        futures = {k: pool.submit(fn) for k, fn in tasks.items()}
        for k, f in futures.items():
            try:
                done[k] = f.result()
            except Exception as exc:  # noqa: BLE001 - collected and re-raised below
                failed[k] = exc
    if failed:
        raise ParallelJobsError(done, failed)
    return done


# Date key of each fact, for date-partitioned writes.
FACT_DATES = {"fact_transactions": "transaction_date_key",
              "fact_payment_plans": "plan_date_key",
              "fact_customer_events": "event_date_key"}


def write_by_day(df: DataFrame, path: str, date_col: str, only_days: bool = False) -> None:
    """Write one folder per day, with output partitions sized by AQE.

    The ``REBALANCE`` hint clusters rows by day and lets AQE size the
    output partitions by bytes: a day holding a third of all rows is split
    over as many tasks (and files) as its size needs, small days are
    coalesced, so file size stays near the advisory partition size whatever
    the skew.  A date filter on the key then prunes whole folders
    (``PartitionFilters``).  With ``only_days`` the folders of days that ``df`` doesn't hold stay as they are.
    """
    (df.hint("rebalance", date_col).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if only_days else "static")
     .partitionBy(date_col).parquet(path))


class Publication:
    """Tables of a layer: each is written beside its last version, and all are switched at the end.

    A write that fails leaves every table of the layer as it was.
    """

    def __init__(self, spark: SparkSession, root: str, partition_facts_by_day: bool = True):
        self.spark, self.root, self.by_day = spark, root.rstrip("/"), partition_facts_by_day
        self._schemas: dict[str, tuple] = {}

    def _read(self, name: str, path: str) -> DataFrame:
        schema, columns = self._schemas[name]
        # the schema is known: reading it back needs no footer-inference job; partition
        # columns come last in the relation, so the order is restored
        return self.spark.read.schema(schema).parquet(path).select(*columns)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Writes the next version; the frame returned reads it until ``publish``."""
        path = f"{self.root}/{name}"
        restore_folder(self.spark, path)
        self._schemas[name] = df.schema, df.columns
        if self.by_day and name in FACT_DATES:
            write_by_day(df, fresh_folder(path), FACT_DATES[name])
        else:
            df.write.mode("overwrite").parquet(fresh_folder(path))
        return self._read(name, fresh_folder(path))

    def publish(self) -> dict[str, DataFrame]:
        """Switches all tables written; frames over the published files."""
        for name in self._schemas:
            publish_folder(self.spark, f"{self.root}/{name}")
        return {name: self._read(name, f"{self.root}/{name}") for name in self._schemas}


def build_warehouse(spark: SparkSession, bronze: dict[str, DataFrame], base_path: str,
                    ctx: RunContext, parallel_jobs: int = 4, partition_facts_by_day: bool = True,
                    join_buckets: int | None = None) -> tuple[dict[str, DataFrame], StoredSilver]:
    """Full refresh in dependency order: bronze, dimensions, then facts.

    Every layer is written once and the next one reads the files, so no
    upstream work is repeated (both dimensions feed all three facts) and
    lineage is cut at each table: a lost executor recomputes from the last
    written layer.  Tables of one layer that do not depend on each other are
    written as concurrent jobs (``parallel_jobs``), so small tables do not
    leave the cluster idle.  With ``partition_facts_by_day`` the facts are
    written partitioned by their date key (see ``write_by_day``), for
    date-filtered reads at scale.  The silver tables are switched to their new versions together at the end
    (``Publication``).  Returns the staging frames (over bronze files) and the
    silver tables, with ``bronze_counts`` taken by the loads.  ``join_buckets``: see ``build_silver``.
    """
    root = base_path.rstrip("/")
    counts: dict[str, dict] = {}

    try:
        stored_bronze = _run_parallel(
            {t: (lambda t=t, df=df: load_table(df, f"{root}/bronze/{t}", t, counts)) for t, df in bronze.items()},
            parallel_jobs)
    except ParallelJobsError as err:   # B7: report every table, loaded or not
        raise BronzeLoadError(LoadReport(
            loaded={t: f"{root}/bronze/{t}" for t in err.done},
            failed={t: f"{type(e).__name__}: {e}" for t, e in err.failed.items()})) from err
    stg, silver = build_silver(spark, stored_bronze, root, ctx, parallel_jobs, partition_facts_by_day, join_buckets)
    silver.bronze_counts = counts
    return stg, silver


def build_silver(spark: SparkSession, stored_bronze: dict[str, DataFrame], base_path: str, ctx: RunContext,
                 parallel_jobs: int = 4, partition_facts_by_day: bool = True,
                 join_buckets: int | None = None) -> tuple[dict[str, DataFrame], StoredSilver]:
    """Dimensions, then facts, from written bronze tables; published together.

    With ``join_buckets`` the plans and the transaction ids are kept in so many buckets of the transaction id, so the join
    of the two large tables shuffles neither (``sources.bucketed``).  The copies are
    written when bronze has changed, and read by every later build of silver.
    """
    root = base_path.rstrip("/")
    layer = Publication(spark, f"{root}/silver", partition_facts_by_day)
    write = layer.write
    stg = {t: stage(stored_bronze[t], t) for t in stored_bronze}
    d = _run_parallel({
        "dim_customers": lambda: write("dim_customers", dims.dim_customers(stg["customers"], ctx)),
        "dim_merchants": lambda: write("dim_merchants", dims.dim_merchants(stg["merchants"], ctx)),
        "dim_dates": lambda: write("dim_dates", dims.dim_dates(spark, ctx)),
    }, parallel_jobs)
    dc, dm = d["dim_customers"], d["dim_merchants"]

    def plans_after_transactions() -> None:
        ft = write("fact_transactions", facts.fact_transactions(stg["transactions"], dc, dm, ctx))
        write("fact_payment_plans", facts.fact_payment_plans(
            stg["payment_plans"], stg["installments"], dc, dm, ft, ctx))

    def plans_from_buckets() -> None:
        plans, sold = plan_buckets(stg, root, join_buckets)
        write("fact_payment_plans", facts.fact_payment_plans_bucketed(
            plans, sold, stg["payment_plans"], stg["installments"], dc, dm, ctx))

    plans_first = {
        "fact_transactions": lambda: write("fact_transactions", facts.fact_transactions(stg["transactions"], dc, dm, ctx)),
        "fact_payment_plans": plans_from_buckets,
    }
    # a key that a dimension repeats multiplies rows of fact_transactions, which the staged ids don't show
    by_bucket = join_buckets and has_unique_keys(dc, "customer_id") and has_unique_keys(dm, "merchant_id")
    _run_parallel({
        **(plans_first if by_bucket else {"txn_and_plans": plans_after_transactions}),
        "fact_customer_events": lambda: write("fact_customer_events", facts.fact_customer_events(
            stg["user_events"], dc, dm, ctx)),
    }, parallel_jobs)
    return stg, StoredSilver(layer.publish())


def has_unique_keys(table: DataFrame, key: str) -> bool:
    return table.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty()


def plan_buckets(stg: dict[str, DataFrame], root: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Staged plans and transaction ids, in buckets of the transaction id."""
    return (bucketed(stg["payment_plans"], "payment_plans", f"{root}/joins", "transaction_id", buckets),
            bucketed(stg["transactions"].select("transaction_id"), "transaction_ids", f"{root}/joins",
                     "transaction_id", buckets))


GOLD_TABLES = ["gold_customer_analytics", "gold_merchant_analytics",
               "gold_transaction_analytics", "gold_payment_analytics"]


def gold_marts(silver, ctx: RunContext) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the four marts over (written) silver tables."""
    from paylater.plans import customer, merchant, payments, transactions
    s = silver
    return {
        "gold_customer_analytics": lambda: customer.gold_customer_analytics(
            s.dim_customers, s.fact_transactions, s.fact_payment_plans, s.fact_customer_events, ctx),
        "gold_merchant_analytics": lambda: merchant.gold_merchant_analytics(
            s.dim_merchants, s.fact_transactions, s.fact_payment_plans, s.fact_customer_events, ctx),
        "gold_transaction_analytics": lambda: transactions.gold_transaction_analytics(
            s.fact_transactions, s.dim_merchants, s.dim_dates, ctx),
        "gold_payment_analytics": lambda: payments.gold_payment_analytics(
            s.fact_payment_plans, s.dim_merchants, s.dim_dates, ctx),
    }


def build_gold(spark: SparkSession, silver, base_path: str, ctx: RunContext,
               parallel_jobs: int = 4) -> dict[str, DataFrame]:
    """Write the four marts (independent, so as concurrent jobs), then publish them; frames over the files."""
    layer = Publication(spark, f"{base_path.rstrip('/')}/gold")
    _run_parallel({n: (lambda n=n, b=b: layer.write(n, b())) for n, b in gold_marts(silver, ctx).items()},
                  parallel_jobs)
    return layer.publish()


def table_schemas(spark: SparkSession, ctx: RunContext) -> dict[str, StructType]:
    """Schemas of the silver and gold tables, from plans over empty sources."""
    empty = {t: add_lineage(spark.createDataFrame([], schema), t, ctx) for t, schema in schemas.SOURCE_SCHEMAS.items()}
    silver = from_bronze(spark, empty, ctx).silver
    return ({t: getattr(silver, t).schema for t in SILVER_TABLES}
            | {t: build().schema for t, build in gold_marts(silver, ctx).items()})


def read_bronze(spark: SparkSession, base_path: str) -> dict[str, DataFrame]:
    """The loaded bronze tables."""
    out = {}
    for table, schema in schemas.SOURCE_SCHEMAS.items():
        whole = (StructType(list(schema.fields)).add(schemas.ETL_EXTRACTED_AT, "timestamp_ntz")
                 .add(schemas.ETL_SOURCE, "string"))
        out[table] = spark.read.schema(whole).parquet(f"{base_path.rstrip('/')}/bronze/{table}")
    return out


def read_silver(spark: SparkSession, base_path: str, ctx: RunContext) -> StoredSilver:
    """The published silver tables (a fact without any row has a folder without files)."""
    known = table_schemas(spark, ctx)
    return StoredSilver({t: spark.read.schema(known[t]).parquet(f"{base_path.rstrip('/')}/silver/{t}")
                         for t in SILVER_TABLES})


__all__ = ["Warehouse", "Silver", "StoredSilver", "from_test_tables", "from_bronze",
           "build_warehouse", "build_silver", "build_gold", "plan_buckets", "gold_marts", "SILVER_TABLES",
           "GOLD_TABLES", "Publication", "read_bronze", "read_silver", "table_schemas"]
