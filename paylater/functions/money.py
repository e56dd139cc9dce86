"""Aggregates that give the same bits on every engine and partitioning.

Summing doubles is order dependent in the last bits, so money is summed as
``DECIMAL(18,2)`` (exact) and cast back to double; an average is that sum
divided by the count.  Ratios are null (or a given default) for a zero
divisor, because ANSI mode raises on division by zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money_sum(x: str | Column) -> Column:
    return F.sum(_c(x).cast(MONEY)).cast("double")


def money_avg(x: str | Column) -> Column:
    col = _c(x)
    return F.sum(col.cast(MONEY)).cast("double") / F.count(col).cast("double")


RATE = "decimal(20,9)"


def rate_avg(x: str | Column) -> Column:
    """Mean of rates at nine digits, summed exactly and divided once."""
    col = _c(x)
    return F.sum(col.cast(RATE)).cast("double") / F.when(F.count(col) > 0, F.count(col).cast("double"))


def ratio(num: str | Column, den: str | Column, default: Column | float | None = None) -> Column:
    """``num / den`` as double; ``default`` (NULL if not given) when ``den`` is 0 or NULL."""
    n, d = _c(num), _c(den)
    out = F.when(d != 0, n.cast("double") / d.cast("double"))
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(float(default)))
    return out


def sorted_set(x: str | Column) -> Column:
    """Distinct non-null values as a sorted array (``array_agg(distinct x)``)."""
    return F.sort_array(F.collect_set(_c(x)))


def text_null_concat(*parts: str | Column) -> Column:
    """Concatenation that treats NULL as empty text."""
    return F.concat(*[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts])
