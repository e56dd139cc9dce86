"""Property tests: the two-step distinct counts equal Spark's own count(distinct)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylater.functions.distinct import keyed_counts, value_sets

ROWS = st.lists(
    st.tuples(st.sampled_from(["g1", "g2", None]),          # group (NULL is a group)
              st.sampled_from(["k1", "k2", "k3", None]),     # key (duplicates and NULLs)
              st.sampled_from(["a", "b", None]),             # type
              st.integers(min_value=0, max_value=5)),
    min_size=0, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_keyed_counts_equal_count_distinct(spark, rows):
    df = spark.createDataFrame(rows, "g string, k string, t string, v long")
    got = keyed_counts(df, ["g"], "k", {"n_a": F.col("t") == "a", "n_b": F.col("t") == "b"}, "n",
                       partials={"s": (F.sum("v"), "sum")})
    want = df.groupBy("g").agg(
        F.count_distinct("k").alias("n"),
        F.count_distinct(F.when(F.col("t") == "a", F.col("k"))).alias("n_a"),
        F.count_distinct(F.when(F.col("t") == "b", F.col("k"))).alias("n_b"),
        F.sum("v").alias("s"))
    cols = ["g", "n", "n_a", "n_b", "s"]
    key = lambda r: (r[0] is None, r[0] or "")
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == \
        sorted(map(tuple, want.select(*cols).collect()), key=key)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_value_sets_equal_sorted_collect_set(spark, rows):
    df = spark.createDataFrame(rows, "g string, k string, t string, v long")
    got = value_sets(df, ["g"], "t", "ts")
    want = df.groupBy("g").agg(F.sort_array(F.collect_set("t")).alias("ts"))
    key = lambda r: (r[0] is None, r[0] or "")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


KEYS = st.lists(st.sampled_from(["a", "b", "c", None]), min_size=0, max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(fact_keys=KEYS, dim_keys=KEYS)
def test_lookup_key_equals_left_join_on_full_dimension(spark, fact_keys, dim_keys):
    from paylater.functions import surrogate_key
    from paylater.operators.facts import lookup, lookup_key
    fact = spark.createDataFrame([(f"r{i}", k) for i, k in enumerate(fact_keys)], "rid string, k string")
    dim = spark.createDataFrame([(k,) for k in dim_keys], "k string").withColumn("k_sk", surrogate_key("k"))
    got = lookup_key(fact, dim, "k", "k_sk", spread_nulls_by="rid").select("rid", "k", "k_sk")
    want = lookup(fact, dim, "k", ["k_sk"]).select("rid", "k", "k_sk")
    key = lambda r: tuple("" if v is None else v for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_merge_groups_equals_null_safe_join_of_same_groups(spark, rows):
    from paylater.functions.distinct import merge_groups, null_safe_join
    df = spark.createDataFrame(rows, "g string, k string, t string, v long")
    a = df.groupBy("g").agg(F.sum("v").alias("s"), F.count_distinct("k").alias("nk"))
    b = value_sets(df, ["g"], "t", "ts")
    got = merge_groups([a, b], ["g"]).select("g", "s", "nk", "ts")
    want = null_safe_join(a, b, ["g"], "left").select("g", "s", "nk", "ts")
    key = lambda r: (r[0] is None, r[0] or "")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
