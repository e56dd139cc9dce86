"""Plans and transactions in buckets of the transaction id: same facts, no shuffle, copies that follow bronze."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from paylater import jobs
from paylater.context import TEST_CONTEXT, shared_dir
from paylater.operators import facts
from paylater.plans import warehouse
from paylater.sources import fixtures
from paylater.sources.bronze import bronze_frames
from paylater.sources.bucketed import bucketed
from tests.conftest import SF_SMALL

BUCKETS = 4


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect()))


def copies(root):
    return {t: sorted(os.listdir(f"{root}/joins/{t}")) for t in os.listdir(f"{root}/joins")}


def one_of_each(df, key):
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*df.columns)).alias("r")).select("r.*")


@pytest.fixture(scope="module")
def built(spark):
    """A build with buckets over dimensions of one row a key, as the declared tests ask."""
    root = shared_dir(spark, "t-buckets")
    src = dict(fixtures.source_tables(spark, SF_SMALL))
    for table, key in (("customers", "customer_id"), ("merchants", "merchant_id")):
        src[table] = one_of_each(src[table], key)
    src["payment_plans"] = src["payment_plans"].withColumn(
        "transaction_id", F.when(F.pmod(F.xxhash64("plan_id"), F.lit(7)) > 0, F.col("transaction_id")))
    stg, silver = warehouse.build_warehouse(spark, bronze_frames(src, TEST_CONTEXT), root, TEST_CONTEXT,
                                            join_buckets=BUCKETS)
    return root, stg, silver


def plain_plans(stg, s):
    return facts.fact_payment_plans(stg["payment_plans"], stg["installments"], s.dim_customers, s.dim_merchants,
                                    s.fact_transactions, TEST_CONTEXT)


def test_plans_from_buckets_equal_the_shuffled_join(spark, built):
    root, stg, s = built
    got = rows(s.fact_payment_plans)
    assert got and got == rows(plain_plans(stg, s))
    assert stg["payment_plans"].where("transaction_id is null").count() > 0
    assert set(copies(root)) == {"payment_plans", "transaction_ids"}


def test_transaction_lookup_shuffles_neither_side(spark, built):
    root, stg, s = built
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans, sold = warehouse.plan_buckets(stg, root, BUCKETS)
        found = facts.lookup_key(plans, sold, "transaction_id", "transaction_sk")
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text or "ShuffledHashJoin" in text
        assert "Exchange" not in text and f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in text
        whole = facts.fact_payment_plans_bucketed(plans, sold, stg["payment_plans"], stg["installments"],
                                                  s.dim_customers, s.dim_merchants, TEST_CONTEXT)
        text = whole._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(transaction_id" not in text and "hashpartitioning(coalesce(transaction_id" not in text
        plain = plain_plans(stg, s)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(coalesce(transaction_id" in plain
        assert rows(whole) == rows(plain_plans(stg, s))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rebuild_reads_the_copies_and_follows_bronze(spark, built):
    root, _, s = built
    before, facts_before = copies(root), rows(s.fact_payment_plans)
    for table in spark.catalog.listTables("joins"):                 # as in a new session
        if table.name.rpartition("_")[2] in {v for vs in before.values() for v in vs}:
            spark.sql(f"DROP TABLE joins.{table.name}")
    jobs.rebuild(spark, root, TEST_CONTEXT, join_buckets=BUCKETS)
    assert copies(root) == before
    assert rows(warehouse.read_silver(spark, root, TEST_CONTEXT).fact_payment_plans) == facts_before
    # a plan whose transaction came late
    late = spark.read.parquet(f"{root}/bronze/payment_plans").where("transaction_id is not null").limit(1)
    late = late.withColumns({"plan_id": F.lit("late-plan"), "transaction_id": F.lit("late-transaction")})
    sale = spark.read.parquet(f"{root}/bronze/transactions").limit(1).withColumn("transaction_id", F.lit("late-transaction"))
    late.write.mode("append").parquet(f"{root}/bronze/payment_plans")
    sale.write.mode("append").parquet(f"{root}/bronze/transactions")
    jobs.rebuild(spark, root, TEST_CONTEXT, join_buckets=BUCKETS)
    after = copies(root)
    assert all(len(after[t]) == 1 and after[t] != before[t] for t in after)      # new copies, old ones gone
    again = warehouse.read_silver(spark, root, TEST_CONTEXT).fact_payment_plans
    assert again.where("plan_id = 'late-plan' and transaction_sk is not null").count() == 1
    assert again.count() == len(facts_before) + 1


def test_broken_off_copy_is_written_again(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(50).selectExpr("if(id % 9 = 0, null, concat('k', id % 20)) AS k", "id").write.parquet(source)
    df = spark.read.parquet(source)
    one = bucketed(df, "t_broken", str(tmp_path / "joins"), "k", 3)
    want = rows(df.where("k is not null"))
    assert rows(one) == want
    (folder,) = os.listdir(tmp_path / "joins" / "t_broken")
    at = tmp_path / "joins" / "t_broken" / folder
    os.remove(at / "_SUCCESS")
    os.remove(next(p for p in at.iterdir() if p.name.startswith("part-")))
    assert rows(bucketed(df, "t_broken", str(tmp_path / "joins"), "k", 3)) == want


def test_repeated_dimension_keys_take_the_plain_join(spark):
    """The fixtures repeat merchant ids: rows multiply in the fact, and the build must follow it."""
    root = shared_dir(spark, "t-buckets-repeats")
    src = dict(fixtures.source_tables(spark, SF_SMALL))
    src["merchants"] = src["merchants"].unionByName(src["merchants"].where("merchant_id is not null").limit(3))
    stg, s = warehouse.build_warehouse(spark, bronze_frames(src, TEST_CONTEXT), root, TEST_CONTEXT, join_buckets=BUCKETS)
    assert not warehouse.has_unique_keys(s.dim_merchants, "merchant_id")
    assert not os.path.exists(f"{root}/joins")
    assert rows(s.fact_payment_plans) == rows(plain_plans(stg, s))
