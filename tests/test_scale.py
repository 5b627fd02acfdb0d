"""Operators that exist for size, against plain ones."""

import os
import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.operators import aggregates as A
from starloom.operators import check_states as C
from starloom.operators import quality as Q
from starloom.operators import series as G
from starloom.operators.ordered import neighbour
from starloom.operators.quantiles import exact_quantiles, quantile_columns
from starloom.sources import sinks, versions
from starloom.sources.catalog import union_by_pattern_files
from starloom.sources.sinks import read_layer, write_checked, write_layer


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("values", [
    [float(x) for x in range(1, 101)], [7.0] * 50, [1.0], [], [0.0, -0.0, 1e300, -1e300, 5e-324] * 3,
    [float(i % 7) for i in range(5000)] + [float("nan"), None], "random", "skewed"])
def test_quantiles_are_exact(spark, values):
    rng = random.Random(3)
    if values == "random":
        values = [rng.gauss(0, 1) for _ in range(20_000)]
    elif values == "skewed":
        values = [rng.choice([1.0, 1.0, 2.0, 10.0 ** rng.randint(-300, 300)]) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    qs = [0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.999, 1]
    own = sorted(v for v in values if v is not None and v == v)
    want = [own[max(0, -(-int(q * 1000) * len(own) // 1000) - 1)] if own else None for q in qs]
    assert exact_quantiles(df, "x", qs).first()[0] == want


def test_quantiles_of_large_longs_and_without_a_job(spark):
    big = 2**60
    df = spark.createDataFrame([(big + i,) for i in range(1000)], "x long").repartition(3)
    assert exact_quantiles(df, "x", [0.25, 1.0]).first()[0] == [big + 249, big + 999]
    failing = df.select(F.raise_error(F.lit("ran")).cast("long").alias("x"))
    cuts = quantile_columns(failing, "x", [0.5])  # nothing runs yet
    with pytest.raises(Exception, match="ran"):
        df.select(cuts[0]).collect()


@pytest.mark.parametrize("tracked", [64, 65_536])
def test_top_values_equal_the_full_count(spark, tracked):
    rng = random.Random(1)
    values = [int(rng.paretovariate(0.7)) for _ in range(30_000)] + [None] * 3000
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(4)
    for k in (1, 5, 50):
        got = [tuple(r) for r in A.top_values(df, "v", k, tracked=tracked, candidates=32).collect()]
        assert sorted(got, key=str) == sorted(map(tuple, A.column_values(df, "v", max_records=k).collect()), key=str)
    flat = spark.range(5000).withColumnRenamed("id", "v")
    assert sorted(r.v for r in A.top_values(flat, "v", 10, tracked=tracked).collect()) == list(range(10))
    assert A.top_values(df.limit(0), "v", 3).count() == 0


def test_a_proven_top_shuffles_no_full_count(spark):
    hot = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 3).otherwise(F.col("id")).alias("v")).repartition(4)
    got = A.top_values(hot, "v", 3)
    assert [r.v for r in got.orderBy(F.desc("ordering")).collect()] == [r.v for r in A.column_values(hot, "v", max_records=3).collect()]


def test_names_of_columns_are_bounded(spark):
    df = spark.range(50).withColumnRenamed("id", "v")
    assert len(A.column_values_list(df, "v")) == 50
    with pytest.raises(ValueError, match="more than 20"):
        A.column_values_list(df, "v", max_names=20)
    assert len(A.column_values_list(df, "v", max_records=10, max_names=20)) == 10


def test_long_series_are_made_in_chunks(spark):
    b = spark.sql("SELECT TIMESTAMP_NTZ'2000-01-01 00:00:00' AS lo, TIMESTAMP_NTZ'2000-01-04 00:00:01' AS hi")
    s = G.date_spine(b, "lo", "hi", "second")
    assert s.rdd.getNumPartitions() > 1 or "repartition" in plan(s).lower()
    assert s.count() == 3 * 86_400 + 1 == s.distinct().count()
    days = spark.sql("SELECT DATE'1900-01-01' AS lo, DATE'2200-01-01' AS hi")
    assert G.day_series_inclusive(days, "lo", "hi").count() == 109_574
    assert G.day_series_inclusive(spark.sql("SELECT DATE'2000-01-02' AS lo, DATE'2000-01-02' AS hi"), "lo", "hi").count() == 1
    assert G.date_spine(spark.sql("SELECT CAST(NULL AS DATE) AS lo, DATE'2000-01-02' AS hi"), "lo", "hi").count() == 0


def test_digest_equality_equals_the_full_comparison(spark):
    a = spark.range(2000).select(F.col("id"), (F.col("id") % 13).cast("string").alias("s"), (F.col("id") / 7).alias("x"))
    odd = a.where("id < 30").select("id", F.lit(None).cast("string").alias("s"), "x")
    for b in (a, a.unionByName(a.where("id % 5 = 0")), a.where("id <> 77").unionByName(odd), a.limit(0), a.withColumn("x", F.col("x") + F.when(F.col("id") == 9, 1e-9).otherwise(0))):
        full, quick = (Q.equality(a, b, digest_buckets=n) for n in (None, 64))
        assert sorted(map(str, full.failures.collect())) == sorted(map(str, quick.failures.collect()))
    assert Q.equality(a.limit(0), a.limit(0), digest_buckets=8).failures.count() == 0


def test_files_are_united_in_one_scan(spark):
    base = tempfile.mkdtemp(prefix="files-")
    spark.createDataFrame([(1, "a")], "id int, name string").write.parquet(f"{base}/t_one.parquet")
    spark.createDataFrame([(2, 2.5)], "ID int, amount double").coalesce(1).write.parquet(f"{base}/t_two.parquet")
    spark.createDataFrame([(3,)], "id long").write.parquet(f"{base}/t_wide.parquet")
    spark.createDataFrame([(9,)], "id int").write.parquet(f"{base}/other.parquet")
    one = union_by_pattern_files(spark, base, "t\\_%", exclude="t_wide", source_column_name="src")
    assert sorted(map(tuple, one.collect())) == [("t_one", 1, "a", None), ("t_two", 2, None, 2.5)]
    assert plan(one).count("FileScan") == 1
    every = union_by_pattern_files(spark, base, "t\\_%", source_column_name="src")
    assert sorted(map(tuple, every.select("src", "id").collect())) == [("t_one", 1), ("t_two", 2), ("t_wide", 3)]
    assert dict(every.dtypes)["id"] == "int" and plan(every).count("FileScan") == 2
    assert union_by_pattern_files(spark, base, "%one", where="id > 1").count() == 0
    with pytest.raises(ValueError, match="no tables match"):
        union_by_pattern_files(spark, base, "nothing%")


def test_range_splitter_has_no_single_task_sample(spark):
    rows = [(p, random.Random(i).randint(0, 10**6)) for i, p in enumerate("ab" * 500)]
    df = spark.createDataFrame(rows, "p string, v int").distinct()
    got = neighbour(df, ["p"], ["v"], "v", "prev", "before", rows_per_range=50)
    assert "TakeOrdered" not in plan(got)
    want = {}
    for p in "ab":
        own = sorted(v for q, v in set(rows) if q == p)
        want |= {(p, v): (own[i - 1] if i else None) for i, v in enumerate(own)}
    assert {(r.p, r.v): r.before for r in got.collect()} == want
    assert Q.sequential_values(spark.range(10).withColumnRenamed("id", "x"), "x").failures.count() == 0


def test_checks_during_a_write_equal_the_suite(spark):
    base = tempfile.mkdtemp(prefix="obs-")
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 10 != 0, F.col("id") % 7).alias("v")).repartition(5)
    checks = [Q.not_null(rows, "v"), Q.unique(rows, "v"), Q.accepted_range(rows, "v", 0, 5), Q.accepted_range(rows, "id", 0)]
    got = write_checked(rows, f"{base}/t", checks)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, Q.run_suite(checks).collect()))
    assert read_layer(spark, f"{base}/t").count() == 1000
    assert write_checked(rows.limit(0), f"{base}/e", [Q.not_null(rows, "v")]).count() == 1


def test_state_checks_read_touched_months_only(spark):
    path = f"{tempfile.mkdtemp(prefix='states-')}/t"

    def rows(data):
        return spark.createDataFrame(data, "k int, day string, v int, c int").withColumn("game_date", F.col("day").cast("date")).drop("day")

    base = [(i, f"2024-{1 + i % 6:02d}-01", None if i % 3 else i, 1) for i in range(60)] + [(99, None, 5, 1)]
    checks = [C.at_least_one("v"), C.not_constant("c"), C.not_null_proportion("v", 0.5), C.recency("game_date", "day", 0, "2024-06-15 00:00:00"),
              C.unique_combination("k"), C.unique_combination("v", "c")]

    def full():
        t = read_layer(spark, path)
        whole = [Q.at_least_one(t, "v"), Q.not_constant(t, "c"), Q.not_null_proportion(t, "v", 0.5),
                 Q.recency(t, "game_date", "day", 0, "2024-06-15 00:00:00"), Q.unique_combination_of_columns(t, ["k"]),
                 Q.unique_combination_of_columns(t, ["v", "c"])]
        return sorted((r.check_index, r.failures) for r in Q.run_suite(whole).collect())

    def states():
        out, read = C.run_state_checks(spark, path, checks)
        return sorted((r.check_index, r.failures) for r in out.collect()), read

    sinks.incremental_refresh(spark, path, lambda since: rows(base), "k")
    got, read = states()
    assert got == full() and len(read) == 7 and dict(got)[1] == 1
    assert states() == (got, [])
    sinks.upsert_partitions(spark, path, rows([(0, "2024-03-05", 8, 2), (200, "2024-09-01", 3, 1)]), "k")
    got, read = states()
    assert got == full() and read == ["_month=2024-01", "_month=2024-03", "_month=2024-09"] and dict(got)[1] == 0
    # a refresh that broke off does not count
    folder = f"{path}__states"
    for kind in os.listdir(folder):
        for run in os.listdir(f"{folder}/{kind}"):
            os.remove(f"{folder}/{kind}/{run}/_SUCCESS")
    got, read = states()
    assert got == full() and len(read) == len(versions.current(spark, path).parts)


def test_states_of_many_refreshes_become_one_folder(spark, monkeypatch):
    monkeypatch.setattr(C, "STATE_FOLDERS", 2)
    path = f"{tempfile.mkdtemp(prefix='states-')}/t"
    for i in range(4):
        rows = spark.createDataFrame([(i, f"2024-0{1 + i}-01")], "k int, day string").withColumn("game_date", F.col("day").cast("date")).drop("day")
        sinks.upsert_partitions(spark, path, rows, "k")
        out, read = C.run_state_checks(spark, path, [C.unique_combination("k"), C.at_least_one("k")])
        assert [r.failures for r in out.collect()] == [0, 0] and len(read) == 1
        assert all(len(os.listdir(f"{path}__states/{k}")) <= 3 for k in os.listdir(f"{path}__states"))


def test_bucketed_layers_join_without_an_exchange(spark, sf_small):
    from starloom.plans.layers import Warehouse
    from starloom.plans.q_scale import bucketed_warehouse
    w, plain = bucketed_warehouse(spark, sf_small), Warehouse(spark, sf_small)
    for name in ("int_player_performance", "int_team_performance"):
        df = getattr(w, name)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            text = plan(getattr(w, name).select("*"))
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert "SortMergeJoin" in text or "BroadcastHashJoin" in text
        assert "hashpartitioning(game_id" not in text and "hashpartitioning(a_game_id" not in text and "hashpartitioning(g_game_id" not in text, text
        assert Counter(map(str, df.collect())) == Counter(map(str, getattr(plain, name).select(*df.columns).collect()))


def test_written_versions_read_as_one_table(spark):
    path = f"{tempfile.mkdtemp(prefix='v-')}/t"
    rows = spark.createDataFrame([(1, "x y/z=1"), (2, None), (3, "é")], "id int, part string")
    write_layer(rows, path, ["part"])
    assert sorted(map(str, read_layer(spark, path).collect())) == sorted(map(str, rows.collect()))


def test_layers_make_their_settings_in_any_session(spark, sf_small):
    from starloom.plans.layers import Warehouse
    from starloom.session import LAYER_CONF
    for k, v in {"spark.sql.codegen.hugeMethodLimit": "65535", "spark.sql.requireAllClusterKeysForCoPartition": "true"}.items():
        spark.conf.set(k, v)
    Warehouse(spark, sf_small)
    assert {k: spark.conf.get(k) for k in LAYER_CONF} == LAYER_CONF


def test_layers_are_dealt_out_by_game_while_narrow(spark, sf_small):
    from starloom.plans.layers import Warehouse
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        text = plan(Warehouse(spark, sf_small).int_player_performance)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert "SortMergeJoin" in text
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    assert shuffles and all("hashpartitioning(game_id" in x and "player_id" not in x for x in shuffles), text


def test_buckets_grow_with_the_lines_and_are_written_without_a_shuffle(spark, sf_small, monkeypatch):
    from starloom.plans import q_scale
    from starloom.plans.layers import Warehouse
    from starloom.plans.raw import Raw
    monkeypatch.setattr(q_scale, "BUCKET_LINES", 500)
    lines = spark.read.parquet(f"{sf_small}/lineitem.parquet").count()
    stored = q_scale.bucketed_warehouse(spark, sf_small).stg_player_game_basic_stats
    assert len(stored.inputFiles()) == -(-lines // 500) > 8
    w = Warehouse(spark, sf_small, raw=Raw(spark, sf_small, 12))
    for name in ("stg_games", "stg_player_game_basic_stats", "stg_player_game_adv_stats_extended", "stg_team_game_basic_stats"):
        df = getattr(w, name)
        assert plan(df.repartition(12, "game_id")).count("Exchange hashpartitioning") == plan(df).count("Exchange hashpartitioning"), name


def test_what_several_steps_read_is_computed_once(spark, sf_small):
    from starloom.plans.q_checks import q_dq_project_suite
    from starloom.plans.q_frames import q_join_junk_dim
    from starloom.plans.q_incremental import q_schema_sync
    for q in (q_join_junk_dim, q_schema_sync):
        assert all("/kept-" in f for f in q(spark, sf_small).inputFiles()), q.__name__
    kept = {f.split("/kept-")[1].split("-")[0] for f in q_dq_project_suite(spark, sf_small).inputFiles() if "/kept-" in f}
    assert kept == {"int_team_performance", "int_player_performance", "int_games_enriched"}
