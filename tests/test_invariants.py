"""Invariants over the written warehouse, on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from paylater.context import TEST_CONTEXT, shared_dir
from paylater.plans import warehouse
from paylater.sources import fixtures
from paylater.sources.bronze import bronze_frames
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def built(spark):
    base = shared_dir(spark, "t-invariants")
    stg, silver = warehouse.build_warehouse(
        spark, bronze_frames(fixtures.source_tables(spark, SF_SMALL), TEST_CONTEXT), base, TEST_CONTEXT)
    gold = warehouse.build_gold(spark, silver, base, TEST_CONTEXT)
    return stg, silver, gold


def test_fact_rows_equal_staging_rows(built):
    stg, s, _ = built
    assert s.fact_transactions.count() == stg["transactions"].count()
    assert s.fact_payment_plans.count() == stg["payment_plans"].count()
    assert s.fact_customer_events.count() == stg["user_events"].count()


def test_customer_mart_totals_match_completed_facts(built):
    _, s, g = built
    mart = g["gold_customer_analytics"].agg(F.sum("total_transactions")).first()[0]
    facts = (s.fact_transactions.where((F.col("status") == "completed") & F.col("customer_sk").isNotNull())
             .count())
    assert mart == facts
    assert g["gold_customer_analytics"].count() == s.dim_customers.count()


def test_daily_status_counts_add_up(built):
    _, _, g = built
    t = g["gold_transaction_analytics"]
    parts = sum(F.col(f"{x}_count") for x in ["completed", "pending", "failed", "cancelled", "refunded"])
    # a few source rows have a status outside the five, which no column counts
    assert t.where(parts > F.col("transaction_count")).count() == 0
    missing = t.agg(F.sum(F.col("transaction_count") - parts)).first()[0]
    assert 0 < missing < 0.01 * t.agg(F.sum("transaction_count")).first()[0]


def test_top_arrays_short_and_sorted(built):
    _, _, g = built
    for r in g["gold_transaction_analytics"].select("top_merchants").collect():
        amounts = [m.total_amount for m in r.top_merchants]
        assert 1 <= len(amounts) <= 5 and amounts == sorted(amounts, reverse=True)
    for r in g["gold_payment_analytics"].select("top_defaulting_merchants", "top_merchants_by_volume").collect():
        assert len(r.top_defaulting_merchants) <= 5 and len(r.top_merchants_by_volume) <= 5
        rates = [m.default_rate for m in r.top_defaulting_merchants]
        assert rates == sorted(rates, reverse=True)
        assert all(m.plan_count >= 5 for m in r.top_defaulting_merchants)
