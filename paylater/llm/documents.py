"""Reading a table of documents for the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def bodies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, body)`` of every row with an id."""
    return (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("body")))


def by_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, body)``: one row per document, shuffled by ``doc_id``.

    Rows without an id are left out.  Where an id repeats, the row with the
    smallest text (by bytes) stands for the document, so repeated rows count
    once and the result does not depend on row order.
    """
    return (bodies(docs, id_col, text_col)
            .groupBy("doc_id").agg(F.min("body").alias("body")))
