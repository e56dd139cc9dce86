"""Top-k per group.

``row_number() <= k`` over a window partitioned by the group lets Spark
plan a ``WindowGroupLimit`` before the shuffle, so each task forwards at
most ``k`` rows per group; the shuffle is bounded by ``groups * k * tasks``
whatever the group sizes are.  Ties are broken by the given order columns
in turn, so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_rows(df: DataFrame, group_cols: list[str], order_cols: list[Column], k: int,
               payload_cols: list[str], rank_col: str = "rank") -> DataFrame:
    """One row per (group, rank) for ranks ``1..k``."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return (df.select(*group_cols, *payload_cols, F.row_number().over(w).alias(rank_col))
            .where(F.col(rank_col) <= k)
            .select(*group_cols, F.col(rank_col).cast("bigint").alias(rank_col), *payload_cols))


def top_k_with_lookup(df: DataFrame, group_cols: list[str], order_cols: list[Column], k: int,
                      payload_cols: list[str], dim: DataFrame, key: str, lookup_cols: list[str],
                      out_cols: list[str], rank_col: str = "rank") -> DataFrame:
    """Top-k rows per group with columns looked up from a dimension by ``key``.

    Ranks first and looks up afterwards, so only k rows per group reach the
    join (not every candidate).  The rows are then ranked again: a key that
    occurs twice in the dimension takes two places, as it would if the join
    came first, and only keys already in the first top-k can reach the
    final one, so the result is the same.
    """
    first = top_k_rows(df, group_cols, order_cols, k, payload_cols, "_first_rank")
    named = first.drop("_first_rank").join(dim.select(key, *lookup_cols), key, "left")
    order = order_cols + [F.col(c).asc_nulls_last() for c in lookup_cols]
    return top_k_rows(named, group_cols, order, k, out_cols, rank_col)


def collect_ranked(ranked: DataFrame, group_cols: list[str], rank_col: str, payload_cols: list[str],
                   out_col: str) -> DataFrame:
    """One row per group with ``out_col``: the payload structs in rank order (at most k)."""
    return (ranked.groupBy(*group_cols)
            .agg(F.sort_array(F.collect_list(F.struct(rank_col, *payload_cols))).alias("_items"))
            .select(*group_cols,
                    F.transform("_items", lambda s: s.dropFields(rank_col)).alias(out_col)))


def json_objects(col: str | Column, money_fields: tuple[str, ...] = ("total_amount",),
                 rate_fields: tuple[str, ...] = ()) -> Column:
    """An array of structs as an array of JSON object texts (the reference's ``json_object``).

    NULL fields are kept (``"merchant_name":null``), and money fields are
    written as two-decimal numbers (rates with six), so that no value turns into
    exponent notation.  The marts keep the typed structs; this is for the
    edge where JSON text is wanted.
    """
    c = F.col(col) if isinstance(col, str) else col

    def one(s: Column) -> Column:
        for f in money_fields:
            s = s.withField(f, s.getField(f).cast("decimal(18,2)"))
        for f in rate_fields:
            s = s.withField(f, s.getField(f).cast("decimal(9,6)"))
        return F.to_json(s, {"ignoreNullFields": "false"})

    return F.transform(c, one)
