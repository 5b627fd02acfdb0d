"""The player fact at size: what is shuffled, and that the lookups find the same."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.operators import joins as J
from starloom.operators.dedupe import latest_per_key
from starloom.plans.layers import Warehouse


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def measured_large(spark):
    """No table is measured small, as at size: only what is said to be bounded is broadcast."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "300", "spark.sql.adaptive.autoBroadcastJoinThreshold": "300",
            "spark.sql.debug.maxToStringFields": "200", "spark.sql.maxMetadataStringLength": "2000"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_player_fact_shuffles_no_wide_rows(spark, sf_small, measured_large):
    lines = plan(Warehouse(spark, sf_small).fct_player_game_stats).splitlines()
    dealt = [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]
    assert dealt and not [x for x in dealt if "true_shooting_pct" in x or "usage_pct" in x]


def test_models_of_a_plan_read_one_shuffle_of_raw_rows(spark, sf_small, measured_large):
    lines = plan(Warehouse(spark, sf_small).fct_player_game_stats).splitlines()
    for key in ("l_orderkey", "o_orderkey"):
        scans = [re.sub(r"^[\s:+-]+|#\d+L?", "", x) for x in lines if f"FileScan parquet [{key}" in x]
        assert len(scans) > 2 and len(set(scans)) == 1


def test_lookup_from_afar_finds_what_lookup_finds(spark):
    fact = spark.createDataFrame([(f"g{i % 7}", None if i % 5 == 0 else f"p{i % 11}", i % 13) for i in range(200)],
                                 "game string, player string, n int")
    dim = spark.createDataFrame([(f"p{i}", f"key{i}") for i in range(8)] + [("p3", "other"), (None, "none"), ("p1", None)],
                                "player string, k string").withColumn("at", F.length("k"))
    take = [("k", "k"), ("at", "size")]
    near = J.lookup(fact, dim, [("player", "player")], take)
    far = J.lookup_from_afar(fact, dim, "player", "player", take, at="game")
    assert far.dtypes == near.dtypes
    assert Counter(map(tuple, far.collect())) == Counter(map(tuple, near.collect()))


def test_texts_come_back_from_afar_as_they_were(spark):
    texts = ["0123456789abcdef" * 2, "ABCDEF", "abc", "", "00", "0g", "d'", "aB12", None, "ää"]
    dim = spark.createDataFrame(list(enumerate(texts)), "id int, k string")
    fact = spark.createDataFrame([(1, i) for i in range(len(texts) + 1)], "at int, id int")
    got = J.lookup_from_afar(fact, dim, "id", "id", [("k", "k")], at="at").collect()
    assert {r.id: r.k for r in got} == dict(enumerate([*texts, None]))


def test_only_keys_read_of_a_latest_row_carry_no_rows(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 4), (2, "c", None), (None, "d", 1), (None, "e", 2)], "id int, name string, at int")
    latest = latest_per_key(df, "id", "at")
    assert sorted(map(tuple, latest.collect()), key=str) == [(1, "b", 4), (2, "c", None), (None, "e", 2)]
    assert sorted([r.id for r in latest.select("id").collect()], key=str) == [1, 2, None]
    assert "min(" not in plan(latest.select("id")) and "min(" in plan(latest)


def test_the_latest_rows_own_zero_is_kept(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "x double, at int")
    assert [str(r.x) for r in latest_per_key(df, "x", "at").collect()] == ["-0.0"]


def test_player_fact_is_the_same_with_a_look_back(spark, sf_small):
    w = Warehouse(spark, sf_small)
    since = spark.sql("SELECT DATE'1998-01-01' AS since")
    whole = w.fct_player_game_stats.filter(F.col("game_date") >= "1998-01-01")
    some = w.fact("fct_player_game_stats", since)
    rows = Counter(map(tuple, some.collect()))
    assert rows and rows == Counter(map(tuple, whole.collect()))
