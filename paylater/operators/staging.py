"""Staging projections T1-T6: named source columns plus the extraction stamp.

A projection is free in Spark: it becomes the ``ReadSchema`` of the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from paylater import schemas

STAGING_COLUMNS: dict[str, list[str]] = {
    name: schema.fieldNames() + [schemas.ETL_EXTRACTED_AT]
    for name, schema in schemas.SOURCE_SCHEMAS.items()
}


def stage(bronze: DataFrame, table: str) -> DataFrame:
    """``stg_<table>``: select the staging columns by name (drops ``_etl_source``)."""
    return bronze.select(*STAGING_COLUMNS[table])
