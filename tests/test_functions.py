import hashlib

from pyspark.sql import functions as F

from starloom.fixed_values import SURROGATE_KEY_NULL
from starloom import functions as X


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_surrogate_key_matches_md5_text(spark):
    df = spark.createDataFrame([(1, "a", None), (None, None, True)], "c1 int, c2 string, c3 boolean")
    got = [r[0] for r in df.select(X.surrogate_key("c1", "c2", "c3")).collect()]
    tok = SURROGATE_KEY_NULL
    want = [hashlib.md5(f"1-a-{tok}".encode()).hexdigest(),
            hashlib.md5(f"{tok}-{tok}-true".encode()).hexdigest()]
    assert got == want
    empty = df.select(X.surrogate_key("c1", "c2", nulls_as_empty=True)).collect()[1][0]
    assert empty == hashlib.md5(b"-").hexdigest()


def test_check_hashable_rejects_double(spark):
    import pytest
    df = spark.createDataFrame([(1.5,)], "x double")
    with pytest.raises(TypeError):
        X.check_hashable(df, ["x"])


def test_safe_arithmetic(spark):
    df = spark.createDataFrame([(1, None, 3), (None, None, None), (5, 0, 2)], "a int, b int, c int")
    out = rows(df.select(X.safe_add("a", "b", "c"), X.safe_subtract(["a", "b", "c"]),
                         X.safe_divide("a", "b")))
    assert out == [(4, -2, None), (0, 0, None), (7, 3, None)]
    assert rows(df.select(X.safe_divide(F.lit(6), F.lit(3))).limit(1)) == [(2.0,)]


def test_width_bucket_formula_quirks(spark):
    df = spark.createDataFrame([(12.0,), (-3.0,), (4.0,), (5.0,), (10.0,)], "x double")
    got = [r[0] for r in df.select(X.width_bucket("x", 0, 10, 5)).collect()]
    # 12 above max -> n+1 capped, plus 1 on an edge; -3 not clamped
    assert got == [7, -1, 3, 3, 6]


def test_urls(spark):
    df = spark.createDataFrame([("https://www.example.com/a/b?utm_source=x&ref=y#top",),
                                ("example.com",), ("http://host.com?x=1",),
                                ("android-app://com.app/path",)], "u string")
    out = rows(df.select(X.url_host("u"), X.url_path("u"), X.url_parameter("u", "ref"),
                         X.url_parameter("u", "utm_source")))
    assert out[0] == ("www.example.com", "a/b", "y#top", "x")
    assert out[1] == ("example.com", "example.com", None, None)
    assert out[2] == ("host.com", "", None, None)
    assert out[3][0] == "com.app"


def test_slugify_cases(spark):
    assert X.slugify("") == ""
    assert X.slugify(None) == ""
    assert X.slugify("!Hell0 world-hi") == "hell0_world_hi"
    assert X.slugify("0Hell0 world-hi") == "_0hell0_world_hi"
    df = spark.createDataFrame([("!Hell0 world-hi",), ("0Hell0 world-hi",), (None,)], "s string")
    assert [r[0] for r in df.select(X.slugify_col("s")).collect()] == [
        "hell0_world_hi", "_0hell0_world_hi", ""]


def test_haversine(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    mi, km = df.select(X.haversine_distance("a", "b", "c", "d"),
                       X.haversine_distance("a", "b", "c", "d", unit="km")).collect()[0]
    assert 267 < mi < 268 and abs(km - mi * 1.60934) < 1e-9


def test_clock_and_guarded_cast(spark):
    df = spark.createDataFrame([("12:30",), ("7",), ("",), (None,), ("DNP",)], "mp string")
    out = [r[0] for r in df.select(X.clock_to_minutes("mp", guarded=True)).collect()]
    assert out == [12.5, 7.0, 0.0, 0.0, 0.0]
    assert [r[0] for r in df.select(X.regex_guarded_cast("mp")).collect()] == [0.0, 7.0, 0.0, 0.0, 0.0]


def test_tiering_and_like(spark):
    df = spark.createDataFrame([("11:30p",), ("7:00p",), ("4:00p",), (None,), ("12:05p",)], "t string")
    from starloom.plans.models.staging import time_slot
    assert [r[0] for r in df.select(time_slot("t")).collect()] == [
        "Afternoon", "Prime Time", "Late Night", "Late Night", "Afternoon"]
    v = spark.createDataFrame([(0.61,), (0.5,), (0.1,)], "x double")
    t = X.tier("x", [(0.6, "Elite"), (0.5, "Average")], "Low")
    assert [r[0] for r in v.select(t).collect()] == ["Elite", "Average", "Low"]


def test_row_argmax_ties_go_first(spark):
    df = spark.createDataFrame([(5, 5, 1, 0), (1, 2, 3, 3)], "a int, b int, c int, d int")
    assert [r[0] for r in df.select(X.row_argmax(["a", "b", "c", "d"], ["A", "B", "C", "D"])).collect()] == ["A", "C"]


def test_dates(spark):
    df = spark.createDataFrame([("2022-10-02",), ("2023-01-15",)], "d string").select(F.col("d").cast("date").alias("d"))
    out = rows(df.select(X.season_start_year("d"), X.season_label(X.season_start_year("d")),
                         X.date_key("d"), X.iso_day_of_week("d"), X.day_name("d", padded=True)))
    assert out[0] == (2022, "2022-23", 20221002, 7, "Sunday   ")
    assert out[1][0] == 2022


def test_data_driven_quartiles(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("x"))
    cuts = X.thresholds_from_data(df, "x", [0.25, 0.5, 0.75])
    assert cuts == [25.0, 50.0, 75.0]
    got = df.groupBy(X.quartile_label("x", cuts).alias("q")).count().orderBy("q").collect()
    assert [(r.q, r["count"]) for r in got] == [("Q1", 24), ("Q2", 25), ("Q3", 25), ("Q4", 26)]
