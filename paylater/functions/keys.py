"""Surrogate keys (operator S1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the surrogate-key recipe: columns are cast to text, NULL is
# replaced by this token, and the parts are joined by '-' before md5.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*cols: str | Column) -> Column:
    """32-character md5 hex key over one or more natural-key columns."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"),
                        F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
