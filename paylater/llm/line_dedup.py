"""Boilerplate lines: lines that many distinct sites share.

1. Lines are keyed by their MD5 digest.  A HyperLogLog sketch of the sites is
   kept for each key; partial sketches merge map-side and again after the
   shuffle, so a line of a third of all documents sends one sketch per task.
2. A line whose estimate is clear of the threshold by more than ``BAND`` is
   decided by it.  For those near the threshold, the distinct sites are counted
   exactly.  (Sketches of few values are near exact, and the band is five standard errors.)
3. The keys found are joined back to the documents' lines; a document's text is
   rebuilt from the lines that stay.

Built-in functions only.  A key needs one row per task and site at most, and
the join back splits hot keys (the found keys are unique on their side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylater.llm import documents

MIN_SITES = 8
LG_REGISTERS = 9
# Five relative standard errors of a sketch of 2**9 registers.
BAND = 5 * 1.04 / 2 ** (LG_REGISTERS / 2)


def _lines(docs: DataFrame) -> DataFrame:
    """``site, row_a, row_b, place, line_key`` of every line that isn't empty.

    ``row_a`` and ``row_b`` name the row: its id, and a digest of its text (ids may repeat).
    """
    return (docs.select("site", "row_a", "row_b", F.posexplode("lines").alias("place", "line"))
            .where("line <> ''")
            .select("site", "row_a", "row_b", "place", F.unhex(F.md5(F.col("line").cast("binary"))).alias("line_key")))


def boilerplate_keys(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``line_key`` of lines on ``min_sites`` distinct sites or more; null sites don't count."""
    sketched = (lines.where("site is not null").groupBy("line_key")
                .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_REGISTERS))).alias("estimate"))
                .where(F.col("estimate") >= min_sites * (1 - BAND) - 1))
    clear = F.col("estimate") > min_sites * (1 + BAND) + 1
    near = (lines.where("site is not null").select("line_key", "site")
            .join(sketched.where(~clear).select("line_key"), "line_key", "left_semi")
            .distinct().groupBy("line_key").agg(F.count("*").alias("sites"))
            .where(F.col("sites") >= min_sites))
    return sketched.where(clear).select("line_key").unionByName(near.select("line_key"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site_col: str = "source",
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with boilerplate lines out of the text, and
    ``n_lines, n_removed`` as a struct column ``line_counts``.

    Lines end at a line feed and are compared as they are.  Empty lines are never removed.
    A null text stays null (no lines); an empty text is one empty line.  Null sites add nothing
    to a line's spread.  Rows are kept one for one, repeated ids and rows too.
    """
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(site_col).alias("site"),
        F.col(id_col).cast("string").alias("row_a"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row_b"), lines.alias("lines"))
    every = _lines(packed.select("site", F.coalesce("row_a", F.lit("")).alias("row_a"), "row_b", "lines"))
    found = (every.select("row_a", "row_b", "place", "line_key")
             .join(boilerplate_keys(every, min_sites), "line_key", "left_semi")
             .groupBy("row_a", "row_b").agg(F.collect_set("place").alias("gone")))
    joined = (packed.select("doc", F.coalesce("row_a", F.lit("")).alias("row_a"), "row_b")
              .join(found, ["row_a", "row_b"], "left")
              .withColumn("lines", F.split(F.coalesce(F.col(f"doc.`{text_col}`"), F.lit("")), "\n", -1)))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"),
                       lambda i: F.element_at("lines", i + 1))
    text = F.when(F.col("gone").isNull(), F.col(f"doc.`{text_col}`")).otherwise(F.array_join(kept, "\n"))
    counts = F.struct(
        F.when(F.col(f"doc.`{text_col}`").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
    columns = [(text if c == text_col else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]
    return joined.select(*columns, counts.alias("line_counts"))


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the lines that eight sources or more share."""
    out = remove_boilerplate(documents.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "line_counts.n_lines", "line_counts.n_removed",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


# Lines by ids that don't repeat, with exact counts of distinct sources.
OP7_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, text IS NULL AS none,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
shared AS (
  SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (
  SELECT l.doc_id, l.none, l.line, l.place, s.line IS NOT NULL AS gone
  FROM lines l LEFT JOIN shared s ON l.line = s.line)
SELECT doc_id, CAST(count(*) FILTER (WHERE NOT none) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
