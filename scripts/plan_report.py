"""Physical-plan summary of the headline queries, as a Markdown table.

    python scripts/plan_report.py [SF_DIR] > docs/PLANS.md

Builds the warehouse once over SF_DIR, then for each headline query counts
in the physical plan as planned (AQE may still turn a sort-merge join into
a broadcast join at run time, and reuses identical exchanges) the
shuffles, broadcasts, sort-merge and broadcast-hash joins, Expand copies
and WindowGroupLimits, first with the default broadcast threshold and then
with broadcasting off, which is how joins to large dimensions run at 100 TB.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paylater.context import TEST_CONTEXT, build_session, shared_dir  # noqa: E402
from paylater.operators import quality  # noqa: E402
from paylater.plans import metrics, warehouse  # noqa: E402
from paylater.sources import fixtures  # noqa: E402
from paylater.sources.bronze import bronze_frames  # noqa: E402

COUNTS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "expand": r"Expand \[",
    "window_limit": r"WindowGroupLimit",
    "scans": r"FileScan parquet",
}


READING = """
Reading the table (facts in folders by day): the customer and merchant marts scan
each of their three facts once and the dimension once; the daily marts scan their fact twice
(totals of a day, and its merchants), the calendar and the merchants once. All
distinct counts of one scan come from one reduction to `(group, key)`, whose
rows are narrow and tagged with their key (`multi_counts`), so there is no
`Expand`. Days are joined by number, so that Spark adds no pruning subquery
that would run a branch again. `WindowGroupLimit` trims the daily top-5 lists of
transactions before their shuffle; the payment mart ranks both orders over the same merchant-day
rows, and looks names up for the rows that either order keeps. The data quality
report scans each table once and shuffles once by key.
"""


def summary(df) -> dict[str, int]:
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString()
    return {k: len(re.findall(p, text)) for k, p in COUNTS.items()}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    ctx = TEST_CONTEXT
    base = shared_dir(spark, "plan-report")
    stg, s = warehouse.build_warehouse(spark, bronze_frames(fixtures.source_tables(spark, sf_dir), ctx),
                                       base, ctx)
    marts = warehouse.gold_marts(s, ctx)
    queries = {**{k: v for k, v in marts.items()},
               "kpi_top_customers": lambda: metrics.top_customers(s.fact_transactions, s.dim_customers),
               "kpi_merchant_default_rates": lambda: metrics.merchant_default_rates(
                   s.fact_payment_plans, s.dim_merchants),
               "dq_report": lambda: quality.dq_report(stg)}
    print(f"# Physical-plan summary ({os.path.basename(sf_dir)}, as planned)\n")
    print(f"Generated by `python scripts/plan_report.py {sf_dir}`.\n")
    print("Counts of operators in the physical plan. 'no broadcast' sets both broadcast "
          "thresholds to -1, as when dimensions are too large to broadcast. AQE may still\n"
          "turn a sort-merge join into a broadcast join at run time and reuses identical\n"
          "exchanges.\n")
    print("| query | setting | " + " | ".join(COUNTS) + " |")
    print("| --- | --- | " + " | ".join("---" for _ in COUNTS) + " |")
    for setting, value in [("default", None), ("no broadcast", "-1")]:
        for k in ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]:
            if value is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, value)
        for name, build in queries.items():
            c = summary(build())
            print(f"| {name} | {setting} | " + " | ".join(str(c[k]) for k in COUNTS) + " |")
    print("\n" + READING.strip())


if __name__ == "__main__":
    main()
