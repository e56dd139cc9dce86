"""Data-quality checks Q1-Q4 (declared column tests), X3 (business rules), X4 (outliers).

A check is a function returning its *violating rows*; the suite returns one
row per declared test ``(table, column, test, failures)``.

Scale notes: the whole suite (``dq_report``) is one scan and one keyed reduction of each table.
Of the single checks, ``not_null`` is one pass per table with one ``count_if`` per
column; ``unique`` is one aggregate per key; ``relationships`` first
reduces the child to one row per key with its row count (map-side
combined, so a key holding a third of the rows is one row per task), then
anti-joins the distinct parent keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylater import schemas
from paylater.functions.distinct import null_safe_join

# The declared column tests of the staging layer.
UNIQUE = [("customers", "customer_id"), ("user_events", "event_id"), ("merchants", "merchant_id"),
          ("transactions", "transaction_id"), ("payment_plans", "plan_id"),
          ("installments", "installment_id")]
NOT_NULL = [
    ("customers", "customer_id"),
    ("user_events", "event_type"), ("user_events", "event_id"), ("user_events", "event_timestamp"),
    ("merchants", "merchant_id"),
    ("transactions", "transaction_id"), ("transactions", "customer_id"),
    ("transactions", "merchant_id"), ("transactions", "transaction_date"), ("transactions", "amount"),
    ("payment_plans", "plan_id"), ("payment_plans", "transaction_id"), ("payment_plans", "customer_id"),
    ("payment_plans", "merchant_id"), ("payment_plans", "plan_date"), ("payment_plans", "total_amount"),
    ("payment_plans", "installment_count"),
    ("installments", "installment_id"), ("installments", "plan_id"),
    ("installments", "installment_number"), ("installments", "amount"), ("installments", "due_date"),
    ("installments", "status"),
]
RELATIONSHIPS = [
    ("transactions", "customer_id", "customers", "customer_id"),
    ("transactions", "merchant_id", "merchants", "merchant_id"),
    ("payment_plans", "transaction_id", "transactions", "transaction_id"),
    ("installments", "plan_id", "payment_plans", "plan_id"),
]

REPORT_SCHEMA = "table string, column string, test string, failures bigint"


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Q1: values of ``column`` held by more than one row (NULL is not a value)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """Q2: rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def relationship_violations(child: DataFrame, column: str, parent: DataFrame,
                            field: str) -> DataFrame:
    """Q3: child key values with no parent, with the number of child rows each.

    The parent keys are not de-duplicated first: repeated keys cannot change
    an anti-join's result, and de-duplicating would aggregate every parent
    key for nothing.
    """
    keys = (child.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")))
    parents = parent.select(F.col(field).alias(column)).where(F.col(column).isNotNull())
    return keys.join(parents, column, "left_anti")


def _report_rows(rows: list[tuple[str, str, str, Column]], df: DataFrame) -> DataFrame:
    """One aggregate pass over ``df`` giving one report row per entry."""
    agg = df.agg(*[c.cast("bigint").alias(f"_{i}") for i, (_, _, _, c) in enumerate(rows)])
    stack = ", ".join(f"'{t}', '{c}', '{k}', _{i}" for i, (t, c, k, _) in enumerate(rows))
    return agg.selectExpr(f"stack({len(rows)}, {stack}) AS (`table`, `column`, `test`, `failures`)")


def not_null_report(tables: dict[str, DataFrame], checks=NOT_NULL) -> DataFrame:
    """Q2 for all declared columns: one pass per table."""
    out = None
    for table in dict.fromkeys(t for t, _ in checks):
        cols = [c for t, c in checks if t == table]
        part = _report_rows([(table, c, "not_null", F.count_if(F.col(c).isNull())) for c in cols],
                            tables[table])
        out = part if out is None else out.unionByName(part)
    return out


def unique_report(tables: dict[str, DataFrame], checks=UNIQUE) -> DataFrame:
    out = None
    for table, col in checks:
        part = _report_rows([(table, col, "unique", F.count(F.lit(1)))],
                            unique_violations(tables[table], col))
        out = part if out is None else out.unionByName(part)
    return out


def relationships_report(tables: dict[str, DataFrame], checks=RELATIONSHIPS) -> DataFrame:
    out = None
    for child, col, parent, field in checks:
        v = relationship_violations(tables[child], col, tables[parent], field)
        part = _report_rows([(child, col, f"relationships:{parent}.{field}",
                              F.coalesce(F.sum("n_records"), F.lit(0)))], v)
        out = part if out is None else out.unionByName(part)
    return out


def dq_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Q4: one row per declared test (6 unique + 23 not_null + 4 relationships), from one scan and one shuffle.

    A row gives one narrow row for each of its keys (its own id in the domain of its table, each foreign key in
    the domain of the parent), and one with the set of its NULL columns if a tested column is NULL.  These are
    counted by domain and key before the shuffle, so a key that a third of all rows hold is one row for
    each task.  Where they meet, a key's counts show repeated ids and missing parents.
    """
    domains = {t: i for i, (t, _) in enumerate(UNIQUE)}
    children: dict[str, list[tuple[str, str]]] = {t: [] for t in domains}
    for child, column, parent, _ in RELATIONSHIPS:
        children[parent].append((child, column))
    most = max(map(len, children.values()))
    tested = {t: [c for table, c in NOT_NULL if table == t] for t in domains}
    nulls = -1                                   # domains of the sets of NULL columns: -1, -2, ...

    def entry(domain: int, role: int, key: Column) -> Column:
        return F.struct(F.lit(domain).alias("domain"), F.lit(role).alias("role"), key.alias("key"))

    every = None
    for table, df in tables.items():
        mask = F.lit(0)
        for bit, c in enumerate(tested[table]):
            mask = mask + F.when(F.col(c).isNull(), 1 << bit).otherwise(0)
        entries = [entry(domains[table], 0, F.col(c).cast("string")) for t, c in UNIQUE if t == table]
        entries += [entry(domains[p], 1 + children[p].index((table, c)), F.col(c).cast("string"))
                    for t, c, p, _ in RELATIONSHIPS if t == table]
        entries.append(entry(nulls - domains[table], 0, F.when(mask != 0, mask.cast("string"))))
        part = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("key is not null")
        every = part if every is None else every.unionByName(part)
    met = every.groupBy("domain", "key").agg(*[F.count_if(F.col("role") == r).alias(f"n{r}") for r in range(most + 1)])
    orphan = [F.sum(F.when(F.col("n0") == 0, F.col(f"n{r}"))).alias(f"orphans{r}") for r in range(1, most + 1)]
    told = (met.groupBy("domain", F.when(F.col("domain") < 0, F.col("key").cast("int")).alias("mask"))
            .agg(F.sum("n0").alias("rows"), F.count_if(F.col("n0") > 1).alias("repeated"), *orphan))
    tests = ([(t, c, "unique", domains[t], "u", 0) for t, c in UNIQUE]
             + [(t, c, "not_null", nulls - domains[t], "n", 1 << tested[t].index(c)) for t, c in NOT_NULL]
             + [(t, c, f"relationships:{p}.{f}", domains[p], "r", 1 + children[p].index((t, c)))
                for t, c, p, f in RELATIONSHIPS])
    declared = every.sparkSession.createDataFrame(
        tests, "`table` string, `column` string, test string, domain int, kind string, arg int")
    kind = F.col("kind")
    failures = (F.when(kind == "u", F.col("repeated"))
                .when(kind == "n", F.when(F.col("mask").bitwiseAND(F.col("arg")) != 0, F.col("rows"))))
    for r in range(1, most + 1):
        failures = failures.when((kind == "r") & (F.col("arg") == r), F.col(f"orphans{r}"))
    return (declared.join(told, "domain", "left").groupBy("table", "column", "test")
            .agg(F.coalesce(F.sum(failures), F.lit(0).cast("bigint")).alias("failures")))


# ---------------------------------------------------------------- X3 business rules

@dataclass(frozen=True)
class Rule:
    table: str
    column: str
    test: str
    violated: Column  # true on a violating row


def _domain(table: str, column: str, values: list) -> Rule:
    c = F.col(column)
    return Rule(table, column, "accepted_values", c.isNotNull() & ~c.isin(*values))


PAID = ["paid", "paid_late"]


def business_rules() -> list[Rule]:
    """Fixed rules: accepted values (source domains), positive amounts, paid dates."""
    return [
        _domain("customers", "country", schemas.COUNTRIES),
        _domain("customers", "status", schemas.CUSTOMER_STATUSES),
        _domain("merchants", "category", schemas.MERCHANT_CATEGORIES),
        _domain("merchants", "country", schemas.COUNTRIES),
        _domain("merchants", "integration_type", schemas.INTEGRATION_TYPES),
        _domain("merchants", "status", schemas.MERCHANT_STATUSES),
        _domain("transactions", "currency", schemas.CURRENCIES),
        _domain("transactions", "payment_method", schemas.PAYMENT_METHODS),
        _domain("transactions", "status", schemas.TRANSACTION_STATUSES),
        Rule("transactions", "amount", "positive", F.col("amount") <= 0),
        _domain("payment_plans", "installment_count", schemas.INSTALLMENT_COUNTS),
        _domain("payment_plans", "status", schemas.PLAN_STATUSES),
        Rule("payment_plans", "total_amount", "positive", F.col("total_amount") <= 0),
        _domain("installments", "status", schemas.INSTALLMENT_STATUSES),
        Rule("installments", "amount", "positive", F.col("amount") <= 0),
        Rule("installments", "paid_date", "set_iff_paid",
             F.col("paid_date").isNotNull() != F.col("status").isin(*PAID)),
        _domain("user_events", "event_type", schemas.EVENT_TYPES),
        _domain("user_events", "platform", schemas.PLATFORMS),
        _domain("user_events", "device_type", schemas.DEVICE_TYPES),
        _domain("user_events", "country", schemas.COUNTRIES),
    ]


CENT = 0.01


def installment_total_violations(plans: DataFrame, installments: DataFrame) -> DataFrame:
    """Plans whose installments do not add up to the plan total within one cent
    each, or are not as many as the plan says (a plan without any is one of these).

    The installments are reduced per plan before the join (one row per
    plan), so the join is plan-to-plan.
    """
    sums = installments.groupBy("plan_id").agg(
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("installments_total"),
        F.count(F.lit(1)).alias("installment_rows"))
    j = plans.select("plan_id", "total_amount", "installment_count").join(sums, "plan_id", "left")
    j = j.withColumns({"installments_total": F.coalesce("installments_total", F.lit(0).cast("decimal(18,2)")),
                       "installment_rows": F.coalesce("installment_rows", F.lit(0).cast("bigint"))})
    diff = F.abs(F.col("installments_total").cast("double") - F.col("total_amount"))
    return j.where((diff > F.col("installment_rows") * CENT + 1e-9)
                   | ~F.col("installment_rows").eqNullSafe(F.col("installment_count")))


def business_rules_report(tables: dict[str, DataFrame], rules: list[Rule] | None = None) -> DataFrame:
    """One row per rule ``(table, column, test, failures)``; one pass per table."""
    rules = rules if rules is not None else business_rules()
    out = None
    for table in dict.fromkeys(r.table for r in rules):
        rs = [r for r in rules if r.table == table]
        part = _report_rows([(table, r.column, r.test,
                              F.count_if(F.coalesce(r.violated, F.lit(False)))) for r in rs],
                            tables[table])
        out = part if out is None else out.unionByName(part)
    inst = _report_rows([("installments", "amount", "sums_to_plan_total", F.count(F.lit(1)))],
                        installment_total_violations(tables["payment_plans"], tables["installments"]))
    return out.unionByName(inst)


# ---------------------------------------------------------------- X4 outliers

IQR_FACTOR = 1.5
DIGIT_BITS, DIGITS = 16, 4      # a double in digits: a window sees at most 2 ** 16 of them


def sortable_bits(value: str) -> Column:
    """The bits of a double as an integer whose digits, read as unsigned, are in the order of the values."""
    bits = F.expr(f"CAST(java_method('java.lang.Double', 'doubleToLongBits', CAST(`{value}` AS DOUBLE)) AS BIGINT)")
    # a negative value's bits fall as it rises; the sign bit is turned so that unsigned order holds
    return F.when(bits < 0, F.bitwise_not(bits)).otherwise(bits.bitwiseXOR(F.lit(-(1 << 63))))


def exact_quantiles(df: DataFrame, by: str, value: str, shares: list[float]) -> DataFrame:
    """Per group the values ``q0, q1, ...`` of rank ``ceil(share * n)``, exact at any size and for any spread.

    Radix selection: values are counted per group (map-side combined).  The counts by the first 16 bits
    of the values (in an order-preserving form) tell which digit holds each rank; among the values with that digit
    the next one does, and four digits are the value.  A window sees the digits of one group and
    prefix, at most 65,536 whatever the values are, never a group's rows or values.
    """
    counts = (df.where(F.col(value).isNotNull()).select(by, F.col(value).alias("_v"))
              .groupBy(by, "_v").agg(F.count("*").alias("_n"))
              .select(by, "_v", "_n", sortable_bits("_v").alias("_u")))
    wanted = None
    for digit in range(1, DIGITS + 1):
        prefix = F.shiftrightunsigned("_u", 64 - DIGIT_BITS * digit).alias("_prefix")
        if wanted is None:
            within = counts.withColumn("_before", F.lit(0).cast("bigint"))
        else:
            within = null_safe_join(
                counts.withColumn("_before", F.shiftrightunsigned("_u", 64 - DIGIT_BITS * (digit - 1))),
                wanted, [by, "_before"])
        keep = [] if wanted is None else [F.first("_ranks").alias("_ranks")]
        sized = within.groupBy(by, "_before", prefix).agg(F.sum("_n").alias("_size"), F.min("_v").alias("_least"), *keep)
        whole = Window.partitionBy(by, "_before")
        ahead = whole.orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
        # digits of one prefix, in unsigned order
        sized = sized.withColumn("_order", F.col("_prefix").bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)))
        sized = sized.withColumn("_ahead", F.coalesce(F.sum("_size").over(ahead), F.lit(0)))
        if wanted is None:
            total = F.sum("_size").over(whole)
            sized = sized.withColumn("_ranks", F.array(*[
                F.struct(F.lit(i).alias("q"), F.greatest(F.lit(1), F.ceil(F.lit(share) * total)).cast("bigint")
                         .alias("rank")) for i, share in enumerate(shares)]))
        inside = F.transform(
            F.filter("_ranks", lambda r: (r["rank"] > F.col("_ahead")) & (r["rank"] <= F.col("_ahead") + F.col("_size"))),
            lambda r: F.struct(r["q"].alias("q"), (r["rank"] - F.col("_ahead")).alias("rank")))
        wanted = (sized.select(by, F.col("_prefix").alias("_before"), inside.alias("_ranks"), "_least")
                  .where(F.size("_ranks") > 0))
        if digit < DIGITS:
            wanted = wanted.drop("_least")
    # all bits are known: a prefix is one value
    found = wanted.select(by, "_least", F.transform("_ranks", lambda r: r["q"]).alias("_q"))
    return found.groupBy(by).agg(*[F.max(F.when(F.array_contains("_q", i), F.col("_least"))).alias(f"q{i}")
                                   for i in range(len(shares))])


def outlier_fences(df: DataFrame, by: str, value: str, factor: float = IQR_FACTOR) -> DataFrame:
    """Per group: first and third quartile and the ``factor`` * IQR fences."""
    q = exact_quantiles(df, by, value, [0.25, 0.75])
    q1, q3 = F.col("q0"), F.col("q1")
    iqr = q3 - q1
    return q.select(by, q1.alias("q1"), q3.alias("q3"),
                    (q1 - iqr * factor).alias("lower_fence"), (q3 + iqr * factor).alias("upper_fence"))


def outliers(df: DataFrame, by: str, value: str, id_col: str, factor: float = IQR_FACTOR) -> DataFrame:
    """Rows outside their group's fences (the NULL group is a group)."""
    fences = outlier_fences(df, by, value, factor)
    j = null_safe_join(df.select(by, id_col, value), fences, [by])
    return j.where((F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence")))
