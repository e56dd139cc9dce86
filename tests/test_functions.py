import datetime as dt
import hashlib

from pyspark.sql import functions as F

from paylater.functions import (day_diff, day_of_week0, days_before, money_avg, money_sum, ratio,
                                sorted_set, surrogate_key, text_null_concat)
from tests.conftest import ts


def test_surrogate_key_matches_md5_recipe_with_null_token(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    got = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert got[0] == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()
    assert got[1] == hashlib.md5(b"a-b").hexdigest()
    single = df.select(surrogate_key("x").alias("k")).first().k
    assert single == hashlib.md5(b"a").hexdigest()


def test_day_diff_counts_midnights(spark):
    df = spark.createDataFrame([(ts("2001-01-01 23:00:00"), ts("2001-01-02 01:00:00")),
                                (ts("2001-01-02 01:00:00"), ts("2001-01-02 23:00:00")),
                                (ts("2001-01-05 00:00:00"), ts("2001-01-01 00:00:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert [r.d for r in df.select(day_diff("a", "b").alias("d")).collect()] == [1, 0, -4]


def test_day_of_week_sunday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 13),)], "d date")
    assert [r.w for r in df.select(day_of_week0("d").alias("w")).collect()] == [0, 6]


def test_days_before_is_midnight_cutoff(spark):
    df = spark.createDataFrame([(ts("2001-07-03 00:00:00"),), (ts("2001-07-02 23:59:59"),)],
                               "t timestamp_ntz")
    flags = [r.f for r in df.select((F.col("t") >= days_before(dt.date(2001, 8, 2), 30)).alias("f"))
             .collect()]
    assert flags == [True, False]


def test_money_sum_is_exact_and_avg_is_sum_over_count(spark):
    vals = [0.1] * 10 + [0.2] * 10 + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    r = df.agg(money_sum("x").alias("s"), money_avg("x").alias("a")).first()
    assert r.s == 3.0
    assert r.a == 3.0 / 20


def test_ratio_zero_and_null_divisor(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 4)], "n long, d long")
    got = [tuple(r) for r in df.select(ratio("n", "d").alias("a"), ratio("n", "d", 0.0).alias("b"))
           .collect()]
    assert got == [(None, 0.0), (None, 0.0), (0.25, 0.25)]


def test_text_null_concat_and_sorted_set(spark):
    df = spark.createDataFrame([(None, "x", "b"), ("a", None, None), ("a", "y", "a")],
                               "f string, l string, c string")
    names = [r.n for r in df.select(text_null_concat("f", F.lit(" "), "l").alias("n")).collect()]
    assert names == [" x", "a ", "a y"]
    assert df.agg(sorted_set("c").alias("s")).first().s == ["a", "b"]


def test_shared_dir_reads_session_and_falls_back_without_setting_conf():
    from paylater.context import shared_dir

    class Conf:
        def __init__(self, value):
            self.value, self.sets = value, []

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

        def set(self, key, value):  # must not be called: the setting is not modifiable
            self.sets.append(key)

    class Ctx:
        master = "local[4]"

        def __init__(self):
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = "file:" + d + "/abc"

    class Session:
        def __init__(self, value):
            self.conf, self.sparkContext = Conf(value), Ctx()

    cluster = Session("hdfs://shared/ckpt")
    assert shared_dir(cluster, "x").startswith("hdfs://shared/ckpt/x-")
    local = Session(None)
    d = shared_dir(local, "y")
    assert d.startswith("file:/") and "/abc/y-" in d and local.conf.sets == []
    assert shared_dir(local, "z").rsplit("/", 1)[0] == d.rsplit("/", 1)[0]
