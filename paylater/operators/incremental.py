"""Incremental batch loads (X1): only rows the target does not hold yet.

``new_by_key`` is exact for any input: a left-anti join on the natural key.
``new_since`` first narrows the target to the time span of the incoming rows, as
a literal predicate that reaches the Parquet scan, so only files and row groups
of that span are read and joined; every incoming row is compared.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def new_by_key(incoming: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is absent from the target (NULL keys are always new)."""
    known = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        known = known & F.col(k).isNotNull()
    # a target row with a NULL key part can never match, so it is not shuffled
    return incoming.join(target.select(*keys).where(known), on=keys, how="left_anti")


def new_since(incoming: DataFrame, target: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """Incoming rows whose key the target lacks, reading the target over the incoming rows' days only.

    An event keeps its day, so a row that is loaded already lies in that span.  No
    incoming row is left out, however late, and a time in the future only
    widens the span.  Rows without a time meet the target's rows without one.
    """
    return new_by_key(incoming, target.where(_span(incoming, ts_col)), keys)


def _span(incoming: DataFrame, ts_col: str) -> Column:
    """Target rows without a time, and those between the first and the last day of the incoming rows."""
    first, last = incoming.agg(F.min(ts_col), F.max(ts_col)).first()
    span = F.col(ts_col).isNull()
    if first is not None:
        low, high = (F.to_timestamp_ntz(F.lit(d.strftime("%Y-%m-%d"))) for d in (first, last + dt.timedelta(days=1)))
        span = span | ((F.col(ts_col) >= low) & (F.col(ts_col) < high))
    return span


IDENTITY = "_identity"


def with_identity(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``rows`` with what names a row: its key, or a digest of ``columns`` where a part of the key is NULL."""
    known = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        known = known & F.col(k).isNotNull()
    text = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})
    key = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]))
    return rows.withColumn(IDENTITY, F.when(known, F.concat(F.lit("k"), key))
                           .otherwise(F.concat(F.lit("d"), F.sha2(text, 256))))


def new_rows(incoming: DataFrame, target: DataFrame, keys: list[str], columns: list[str],
             ts_col: str | None = None) -> DataFrame:
    """Incoming rows that the target lacks, each once: a load that is repeated adds nothing.

    A row is named by its key, or by all its ``columns`` where the key is NULL.  Of incoming rows with
    one key the smallest (by columns) is taken.  With ``ts_col`` the target is read over the
    incoming rows' days only.
    """
    if ts_col is not None:
        target = target.where(_span(incoming, ts_col))
    once = (with_identity(incoming, keys, columns).groupBy(IDENTITY)
            .agg(F.min(F.struct(*columns, *[c for c in incoming.columns if c not in columns])).alias("_row"))
            .select(IDENTITY, "_row.*"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    # only rows without a key are read whole
    held = (with_identity(target.where(~null_key).select(*keys), keys, keys)
            .unionByName(with_identity(target.where(null_key).select(*columns), keys, columns)
                         .select(*keys, IDENTITY)).select(IDENTITY))
    return once.join(held, IDENTITY, "left_anti").select(*incoming.columns)


def append(df: DataFrame, path: str) -> None:
    """Append the new rows to the target table's folder."""
    df.write.mode("append").parquet(path)
