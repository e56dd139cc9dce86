"""Source readers B1-B3: relational database, CSV files, CSV table loads.

Schemas are explicit (no inference) and reads fail fast on malformed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylater import schemas

CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd[ HH:mm:ss[.SSSSSS]]"


def range_predicates(column: str, cuts: list[str]) -> list[str]:
    """Conditions that split a text, date or number column at ``cuts`` into ranges without overlap.

    Together they hold every row once; rows where the column is NULL are in the first.
    """
    quoted = ["'" + c.replace("'", "''") + "'" for c in sorted(set(cuts))]
    if not quoted:
        return ["1 = 1"]
    first = f"{column} < {quoted[0]} OR {column} IS NULL"
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(quoted, quoted[1:])]
    return [first, *inner, f"{column} >= {quoted[-1]}"]


CUT_SAMPLES = 64              # sampled keys for each range


def cut_points(held: DataFrame, column: str, ranges: int) -> list[str]:
    """Texts that cut a key column into ranges of near-equal counts: quantiles of a sample of the last load.

    Keys are sampled by hash, about ``CUT_SAMPLES`` for each range, whatever the table's size.
    """
    keys = held.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("k"))
    share = max(1, keys.count() // (CUT_SAMPLES * max(ranges, 1)))
    sample = sorted(r.k for r in keys.where(F.pmod(F.xxhash64("k"), F.lit(share)) == 0).distinct().collect())
    places = [j * len(sample) // ranges for j in range(1, ranges)]
    return sorted({sample[i] for i in places if 0 < i < len(sample)})


def read_jdbc(spark: SparkSession, url: str, table: str, *, predicates: list[str],
              properties: dict[str, str] | None = None) -> DataFrame:
    """B1: full-table extract, one concurrent read for each predicate (see ``range_predicates``).

    The source keys are text, which Spark cannot split by numeric bounds.
    The driver jar and network access must be provided by the cluster;
    nothing here opens a connection until an action runs.
    """
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """B2: CSV with header, typed by the table's schema, timestamps as ``timestamp_ntz``."""
    return (spark.read
            .schema(schemas.SOURCE_SCHEMAS[table])
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
            .csv(path))


def read_csv_text_dates(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV read with every ``*date*`` column as text, then cast to a timestamp.

    This mirrors a loader that only knows that columns named like dates hold
    dates: those are parsed, everything else keeps the declared type.
    """
    declared = schemas.SOURCE_SCHEMAS[table]
    as_text = T.StructType([
        T.StructField(f.name, T.StringType() if "date" in f.name.lower() else f.dataType, True)
        for f in declared.fields
    ])
    raw = (spark.read.schema(as_text).option("header", True).option("mode", "FAILFAST").csv(path))
    return raw.select(*[
        F.to_timestamp_ntz(F.col(f.name)).alias(f.name) if "date" in f.name.lower() else F.col(f.name)
        for f in declared.fields
    ])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with header (used to stage source extracts)."""
    (df.write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))
