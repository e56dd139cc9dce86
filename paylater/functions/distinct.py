"""Distinct counts, plain and conditional, without one ``Expand`` copy each.

``count(distinct key) FILTER (WHERE cond_i)`` for n conditions makes
Spark's distinct-aggregate rewrite copy every row n times.  Here rows are
first reduced to one per ``(group, key)`` carrying a 0/1 flag per
condition (``max``), and the flags are then summed per group.  The first
step shuffles by ``(group, key)``, which spreads a hot group over all
tasks; the second step has map-side partial aggregation, so a group that
holds a third of all rows is combined before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_counts(df: DataFrame, by: list[str], key: str, flags: dict[str, Column],
                 count_name: str, partials: dict[str, tuple[Column, str]] | None = None) -> DataFrame:
    """Per group: ``count(distinct key)`` as ``count_name`` and one conditional distinct per flag.

    ``partials`` maps an output name to ``(row_aggregate, combine)``, where
    ``row_aggregate`` is an aggregate over the rows of one ``(group, key)``
    and ``combine`` is ``"sum"``, ``"min"`` or ``"max"`` over those partial
    results, for additive measures computed in the same pass.  Rows with a
    NULL key count in the partials but not in the distinct counts.
    """
    partials = partials or {}
    aggs = [*[F.max(cond.cast("int")).alias(f"_f_{name}") for name, cond in flags.items()],
            *[agg.alias(f"_p_{name}") for name, (agg, _) in partials.items()]]
    level1 = df.groupBy(*by, key).agg(*aggs) if aggs else df.select(*by, key).distinct()
    has_key = F.col(key).isNotNull()
    zero = F.lit(0).cast("bigint")
    combine = {"sum": F.sum, "min": F.min, "max": F.max}
    return level1.groupBy(*by).agg(
        F.count(key).alias(count_name),
        *[F.coalesce(F.sum(F.when(has_key, F.col(f"_f_{name}"))).cast("bigint"), zero).alias(name)
          for name in flags],
        *[combine[how](F.col(f"_p_{name}")).alias(name) for name, (_, how) in partials.items()],
    )


def multi_counts(df: DataFrame, by: list[str], keys: dict[str, str], flags: dict[str, tuple[str, Column]] | None = None,
                 partials: dict[str, tuple[Column, str]] | None = None, sets: dict[str, str] | None = None) -> DataFrame:
    """Per group, distinct counts of several keys, from one scan and one large shuffle.

    ``keys``: output name -> column.  ``flags``: output name -> (one of the outputs of ``keys``, condition): the
    distinct keys with a row that meets the condition.  ``partials``: output name -> (row expression, ``"sum"``,
    ``"min"``, ``"max"`` or ``"count"``).  ``sets``: output name -> column of few values, whose sorted distinct
    values are listed.  NULL keys and values count for none; NULL groups are groups.

    A row gives one narrow row for each key, tagged with the key's number, and rows are reduced
    to one for each ``(group, key)`` before the shuffle, which spreads a hot group by its keys.  Measures ride on
    the first key only.  (Spark's own rewrite copies whole rows, and once more for plain aggregates.)
    """
    flags, partials, sets = flags or {}, partials or {}, sets or {}
    names, listed = list(keys), list(sets)
    columns = [keys[n] for n in names] + [sets[n] for n in listed]
    tagged = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).cast("string").alias("v"))
                                 for i, c in enumerate(columns)]))
    measured = {f"_f_{n}": cond for n, (_, cond) in flags.items()} | {f"_p_{n}": e for n, (e, _) in partials.items()}
    rows = df.select(*by, *[e.alias(n) for n, e in measured.items()], tagged.alias("_e"))
    rows = rows.select(*by, *measured, F.col("_e.k").alias("_k"), F.col("_e.v").alias("_v"))
    kind = F.col("_k")
    how = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
    first = [F.max((F.col(f"_f_{n}") & (kind == names.index(k))).cast("int")).alias(f"_f_{n}")
             for n, (k, _) in flags.items()]
    first += [how[h](F.when(kind == 0, F.col(f"_p_{n}"))).alias(f"_p_{n}") for n, (_, h) in partials.items()]
    level1 = rows.groupBy(*by, "_k", "_v")
    level1 = level1.agg(*first) if first else rows.select(*by, "_k", "_v").distinct()
    zero = F.lit(0).cast("bigint")
    has_key = F.col("_v").isNotNull()
    again = how | {"count": F.sum}
    second = [F.count(F.when(kind == i, F.col("_v"))).alias(n) for i, n in enumerate(names)]
    second += [F.coalesce(F.sum(F.when(has_key, F.col(f"_f_{n}"))).cast("bigint"), zero).alias(n) for n in flags]
    second += [again[h](F.col(f"_p_{n}")).alias(n) for n, (_, h) in partials.items()]
    if not sets:
        return level1.groupBy(*by).agg(*second)
    # one more row for each value of a set, then one row for each group
    value = F.when(kind >= len(names), F.struct("_k", "_v"))
    level2 = level1.withColumn("_s", F.when(value["_v"].isNotNull(), value)).groupBy(*by, "_s").agg(*second)
    return level2.groupBy(*by).agg(
        *[F.sum(n).alias(n) for n in [*names, *flags]],
        *[again[h](F.col(n)).alias(n) for n, (_, h) in partials.items()],
        *[F.sort_array(F.collect_list(F.when(F.col("_s._k") == len(names) + i, F.col("_s._v")))).alias(n)
          for i, n in enumerate(listed)])


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join where NULL keys match each other (rows meet their NULL group).

    Used to attach per-group results back to rows; to combine aggregates of
    the same groups use ``merge_groups``, which needs no shuffle.  Both
    sides are aliased, so frames derived from the same source join without
    ambiguous column references.
    """
    lft, rgt = left.alias("_l"), right.alias("_r")
    cond = None
    for c in on:
        e = F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}"))
        cond = e if cond is None else cond & e
    return lft.join(rgt, cond, how).select(
        *[F.col(f"_l.{c}").alias(c) for c in on],
        *[F.col(f"_l.{c}").alias(c) for c in left.columns if c not in on],
        *[F.col(f"_r.{c}").alias(c) for c in right.columns if c not in on])


def value_sets(df: DataFrame, by: list[str], col: str, out: str) -> DataFrame:
    """Per group, the sorted distinct non-NULL values of ``col`` (``array_agg(distinct)``).

    Meant for a column with a small domain (currencies): the array per group
    is as long as the number of distinct values.  Reduced to distinct
    ``(group, value)`` pairs first, with map-side partial
    aggregation, so the array per group is bounded by the number of distinct
    values, and the main aggregate stays a hash aggregate (an object-typed
    ``collect_set`` next to distinct counts makes Spark fall back to
    sort-based aggregation).
    """
    return (df.select(*by, col).distinct()
            .groupBy(*by).agg(F.sort_array(F.collect_list(col)).alias(out)))


def merge_groups(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """One row per group from aggregates of the *same* groups computed separately.

    Each part has one row per group and its own value columns.  The parts
    are stacked (missing columns NULL) and regrouped, taking each column
    from the part that has it.  A union keeps its children's hash
    partitioning on the keys, so the regroup adds no shuffle, and a NULL
    key groups with itself, where a join would need a null-safe condition
    and a new shuffle on rewritten keys.
    """
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def join_days(daily: DataFrame, date_col: str, *others: DataFrame) -> DataFrame:
    """Left joins of per-day results on their day; a NULL day of ``daily`` meets nothing.

    All sides come from one fact whose folders are its days.  A join on the partition column itself would have Spark
    prune the folders of one side by running another side once more, which prunes nothing here; a
    derived day number joins without that.
    """
    out = daily
    for i, other in enumerate(others):
        right = other.withColumnRenamed(date_col, f"_day{i}")
        out = out.join(right, F.unix_date(F.col(date_col)) == F.unix_date(F.col(f"_day{i}")), "left").drop(f"_day{i}")
    return out
