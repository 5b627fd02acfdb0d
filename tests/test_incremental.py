import os
import signal
import subprocess
import sys
import tempfile
import time

import pytest

from pyspark.sql import functions as F

from starloom.plans.layers import FACTS, Warehouse, build_warehouse
from starloom.sources import sinks
from starloom.sources import versions
from starloom.sources.sinks import incremental_refresh, merge_by_key, read_layer, sync_schema, write_layer


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_and_schema_sync(spark):
    target = spark.createDataFrame([(1, "a", True), (2, "b", False)], "k int, v string, old boolean")
    delta = spark.createDataFrame([(2, "B", 1.5), (3, "C", 2.5)], "k int, v string, new double")
    assert sync_schema(target, delta).columns == ["k", "v", "new"]
    assert _rows(merge_by_key(target, delta, "k")) == [(1, "a", None), (2, "B", 1.5), (3, "C", 2.5)]


def test_incremental_refresh_moves_keys_between_partitions(spark):
    base = tempfile.mkdtemp(prefix="inc-")
    path = f"{base}/t"
    first = spark.createDataFrame([(1, "2024-01-05", "x"), (2, "2024-02-20", "y"), (3, "2024-03-01", "z")],
                                  "k int, d string, v string").withColumn("game_date", F.col("d").cast("date")).drop("d")
    assert incremental_refresh(spark, path, lambda since: first, "k") == "full"
    # key 1 moves from January to March; key 3 changes; key 4 is new
    delta = spark.createDataFrame([(1, "2024-03-02", "x2"), (3, "2024-03-01", "z2"), (4, "2024-03-03", "w")],
                                  "k int, d string, v string").withColumn("game_date", F.col("d").cast("date")).drop("d")
    assert incremental_refresh(spark, path, lambda since: delta, "k") == "incremental"
    got = _rows(read_layer(spark, path).select("k", "v"))
    assert got == [(1, "x2"), (2, "y"), (3, "z2"), (4, "w")]


def test_incremental_facts_equal_full_refresh(spark, sf_small):
    out = tempfile.mkdtemp(prefix="wh-")
    build_warehouse(spark, sf_small, out)
    build_warehouse(spark, sf_small, out, FACTS)  # look-back upsert of every fact
    w = Warehouse(spark, sf_small)
    for name in ("fct_game_results", "fct_quarter_scoring"):
        stored = read_layer(spark, f"{out}/{name}").drop("_month")
        full = getattr(w, name)
        assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0, name


def test_player_key_is_looked_up(spark, sf_small):
    from starloom.plans.models import facts as FCT
    w = Warehouse(spark, sf_small)
    few = w.dim_players.where("player_id > 'P3'")
    rows = FCT.fct_player_game_stats(w.int_player_performance, w.int_games_enriched, w.dim_player_game_archetypes,
                                     few, w.dim_teams, w.dim_dates, w.dim_seasons, w.dim_arenas)
    assert rows.where("player_key IS NULL").count() > 0  # a stale dimension gives no key
    assert rows.join(few, "player_key", "left_anti").where("player_key IS NOT NULL").count() == 0


def _dated(spark, rows):
    return spark.createDataFrame(rows, "k string, d string, v int").withColumn("game_date", F.col("d").cast("date")).drop("d")


def test_upsert_keeps_undated_rows(spark):
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"
    incremental_refresh(spark, path, lambda since: _dated(spark, [("u1", None, 1), ("u2", None, 2), ("d1", "2024-01-02", 3)]), "k")
    sinks.upsert_partitions(spark, path, _dated(spark, [("u1", "2024-01-06", 10)]), "k")
    assert _rows(read_layer(spark, path).select("k", "v")) == [("d1", 3), ("u1", 10), ("u2", 2)]
    sinks.upsert_partitions(spark, path, _dated(spark, [("u2", "2024-02-06", 20)]), "k")  # the NULL partition empties
    assert _rows(read_layer(spark, path).select("k", "v")) == [("d1", 3), ("u1", 10), ("u2", 20)]


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


STEPS = ["_write_run", "_locate", "_pairs", "versions.commit", "versions._write_new"]


def _break(m, step):
    def broken(*_, **__):
        raise RuntimeError("lost")

    at, name = (versions, step.split(".")[1]) if "." in step else (sinks, step)
    m.setattr(at, name, broken)


@pytest.mark.parametrize("step", STEPS)
def test_a_broken_write_leaves_the_old_table(spark, monkeypatch, step):
    """The first load, an upsert and a full refresh, each broken at each step and run again."""
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"
    old = _dated(spark, [("a", "2024-01-02", 1), ("b", "2024-02-02", 2), ("c", "2024-03-01", 3)])
    delta = _dated(spark, [("a", "2024-03-03", 9)])

    def rows():
        return _rows(read_layer(spark, path).select("k", "v"))

    with monkeypatch.context() as m:
        _break(m, step)
        with pytest.raises(RuntimeError):
            incremental_refresh(spark, path, lambda since: old, "k")
    assert versions.current(spark, path) is None
    # nothing was finished: the load is full again, and rows before the look-back come too
    assert incremental_refresh(spark, path, lambda since: old if since is None else old.limit(0), "k") == "full"
    assert rows() == [("a", 1), ("b", 2), ("c", 3)]
    for load in (lambda: sinks.upsert_partitions(spark, path, delta, "k"),
                 lambda: incremental_refresh(spark, path, lambda since: delta, "k", full_refresh=True)):
        before = rows()
        with monkeypatch.context() as m:
            _break(m, step)
            with pytest.raises(RuntimeError):
                load()
        assert rows() == before
        load()
    assert rows() == [("a", 9)]
    v = versions.current(spark, path)
    assert v.number == 3 and len(os.listdir(f"{path}/versions")) <= 2 * versions.KEPT_VERSIONS


def test_a_job_that_dies_while_writing_leaves_the_old_table(spark):
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"
    write_layer(spark.range(3), path)
    bad = spark.range(1000).repartition(4).withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        write_layer(bad, path)
    assert _rows(read_layer(spark, path)) == [(0,), (1,), (2,)]
    write_layer(spark.range(2), path)
    write_layer(spark.range(1), path)
    assert _rows(read_layer(spark, path)) == [(0,)]
    assert len(os.listdir(f"{path}/data")) == versions.KEPT_VERSIONS  # the broken and the oldest files are gone


_WRITER = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from starloom.session import get_session
from starloom.sources.sinks import write_layer
spark = get_session("local[2]", shuffle_partitions=2)
slow = F.udf(lambda i: __import__("time").sleep(0.2) or i, "long")
write_layer(spark.range(0, 4000, 1, 400).select(slow("id").alias("id")), {path!r})
"""


def test_a_killed_process_leaves_the_old_table(spark):
    """SIGKILL while the files are being written, then the same write again."""
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"
    write_layer(spark.range(3), path)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    writer = subprocess.Popen([sys.executable, "-c", _WRITER.format(root=root, path=path)], stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL,
                              start_new_session=True)
    try:
        end = time.time() + 120
        while time.time() < end and not any("part-" in f for d, _, names in os.walk(f"{path}/data") if "_temporary" in d for f in names):
            time.sleep(0.2)
        assert len(os.listdir(f"{path}/data")) == 2 and writer.poll() is None
    finally:
        os.killpg(writer.pid, signal.SIGKILL)
        writer.wait()
    assert _rows(read_layer(spark, path)) == [(0,), (1,), (2,)]
    write_layer(spark.range(4), path)
    assert read_layer(spark, path).count() == 4 and len(os.listdir(f"{path}/data")) == 2  # without the killed run's


def test_of_two_runs_the_second_to_finish_fails(spark, monkeypatch):
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"
    write_layer(spark.range(1), path)
    seen = versions.current(spark, path)
    write_layer(spark.range(2), path)
    monkeypatch.setattr(versions, "current", lambda *_: seen)
    with pytest.raises(versions.ConcurrentWrite):
        write_layer(spark.range(3), path)
    monkeypatch.undo()
    assert read_layer(spark, path).count() == 2


def test_a_plain_folder_becomes_a_table(spark):
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"
    rows = _dated(spark, [("a", "2024-01-02", 1), ("b", None, 2)]).withColumn("_month", sinks.partition_month("game_date"))
    rows.write.partitionBy("_month").parquet(path)
    assert incremental_refresh(spark, path, lambda since: _dated(spark, [("a", "2024-01-05", 7)]), "k") == "incremental"
    assert _rows(read_layer(spark, path).select("k", "v")) == [("a", 7), ("b", 2)]
    os.remove(f"{path}/versions/{versions.current(spark, path).number:010d}.json")  # back to the version before
    assert _rows(read_layer(spark, path).select("k", "v")) == [("a", 1), ("b", 2)]


def test_only_touched_months_and_buckets_are_read_and_written(spark):
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"
    days = [(f"k{i}", f"2024-{1 + i % 12:02d}-05", i) for i in range(600)]
    incremental_refresh(spark, path, lambda since: _dated(spark, days), "k")
    before = _files(path)
    months = lambda files: {f.split("_month=")[1][:7] for f in files}
    sinks.upsert_partitions(spark, path, _dated(spark, [("k0", "2024-05-09", -1)]), "k")  # moves from January to May
    new = _files(path) - before
    assert months(new) == {"2024-01", "2024-05"}
    v = versions.current(spark, path)
    assert sorted(p for p, r in v.parts.items() if r in {f.split("__run=")[1][:32] for f in new}) == ["_month=2024-01", "_month=2024-05"]
    read = sinks._located(spark, path, v.locator, [3]).inputFiles()
    assert read and all("__bucket=3/" in f for f in read)
    got = _rows(read_layer(spark, path).select("k", "v"))
    assert got == sorted([("k0", -1)] + [(k, n) for k, _, n in days[1:]])
    # the locator gained one pair, and an upsert of the same rows adds none
    pairs = sinks._located(spark, path, v.locator).count()
    assert pairs == 601
    sinks.upsert_partitions(spark, path, _dated(spark, [("k0", "2024-05-09", -1)]), "k")
    assert sinks._located(spark, path, versions.current(spark, path).locator).count() == 601


def test_a_locator_of_many_runs_becomes_one(spark, monkeypatch):
    monkeypatch.setattr(sinks, "LOCATOR_RUNS", 3)
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"
    for i in range(6):
        sinks.upsert_partitions(spark, path, _dated(spark, [("a", f"2024-0{1 + i}-02", i), (f"k{i}", "2024-01-02", i)]), "k")
        assert len(versions.current(spark, path).locator["runs"]) <= 3
    assert _rows(read_layer(spark, path).select("k", "v")) == [("a", 5)] + [(f"k{i}", i) for i in range(6)]
    assert sinks._located(spark, path, versions.current(spark, path).locator).count() == 12


def test_schema_versions_leave_untouched_files(spark):
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"

    def rows(data, columns):
        return spark.createDataFrame(data, columns).withColumn("game_date", F.col("d").cast("date")).drop("d")

    incremental_refresh(spark, path, lambda since: rows([(1, "2024-01-05", "x", 1), (2, "2024-02-20", "y", 2)], "k int, d string, gone string, n int"), "k")
    before = _files(path)
    # a column more, a column less, a wider type
    sinks.upsert_partitions(spark, path, rows([(2, "2024-02-21", 2.5, 5)], "k int, d string, extra double, n long"), "k")
    assert {f for f in before if "2024-01" in f} <= _files(path)
    got = read_layer(spark, path)
    assert dict(got.dtypes)["n"] == "bigint" and sorted(c for c in got.columns if c != "_month") == ["extra", "game_date", "k", "n"]
    assert _rows(got.select("k", "extra", "n")) == [(1, None, 1), (2, 2.5, 5)]
    # the lost column comes back: old values do not
    sinks.upsert_partitions(spark, path, rows([(3, "2024-03-01", "z", 1)], "k int, d string, gone string, n long"), "k")
    assert _rows(read_layer(spark, path).select("k", "gone")) == [(1, None), (2, None), (3, "z")]
    # a type that not every value fits is cast once, by rewriting all
    old = _files(path)
    sinks.upsert_partitions(spark, path, rows([(4, "2024-04-01", "z", 1)], "k int, d string, gone string, n int"), "k")
    assert dict(read_layer(spark, path).dtypes)["n"] == "int" and read_layer(spark, path).count() == 4
    v = versions.current(spark, path)
    assert len(set(v.parts.values())) == 1 and not {r for f in old for r in [f.split("__run=")[1][:32]]} & set(v.parts.values())


def test_full_refresh_reloads_all_rows(spark):
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"
    incremental_refresh(spark, path, lambda since: _dated(spark, [("a", "2020-01-02", 1), ("b", "2024-02-02", 2)]), "k")
    new = _dated(spark, [("a", "2020-01-02", 5), ("c", None, 6)])
    assert incremental_refresh(spark, path, lambda since: new if since is None else new.limit(0), "k", full_refresh=True) == "full"
    assert _rows(read_layer(spark, path).select("k", "v")) == [("a", 5), ("c", 6)]
    write_layer(new.limit(0).withColumn("_month", F.lit("x")), path, ["_month"], key=["k"])
    assert read_layer(spark, path).count() == 0 and "v" in read_layer(spark, path).columns


def test_late_older_version_does_not_win(spark):
    path = f"{tempfile.mkdtemp(prefix='inc-')}/t"
    row = lambda v, ver: spark.createDataFrame([("a", v, ver, "2024-01-02")], "k string, v int, ver int, d string").select(
        "k", "v", "ver", F.col("d").cast("date").alias("game_date"))
    for v, ver in ((1, 1), (3, 3), (2, 2)):
        sinks.upsert_partitions(spark, path, row(v, ver), "k", version_col="ver")
    assert _rows(read_layer(spark, path).select("v")) == [(3,)]


def test_incremental_schema_change_rewrites_all_partitions(spark):
    base = tempfile.mkdtemp(prefix="inc-")
    path = f"{base}/t"
    first = spark.createDataFrame([(1, "2024-01-05", "x"), (2, "2024-02-20", "y")],
                                  "k int, d string, v string").withColumn("game_date", F.col("d").cast("date")).drop("d")
    incremental_refresh(spark, path, lambda since: first, "k")
    # the model gained a column and lost v
    delta = spark.createDataFrame([(2, "2024-02-21", 2.5)], "k int, d string, w double") \
        .withColumn("game_date", F.col("d").cast("date")).drop("d")
    assert incremental_refresh(spark, path, lambda since: delta, "k") == "incremental"
    stored = read_layer(spark, path)
    assert sorted(c for c in stored.columns if c != "_month") == ["game_date", "k", "w"]
    assert _rows(stored.select("k", "w")) == [(1, None), (2, 2.5)]


def test_ordered_dimensions_come_sorted(spark, sf_small):
    from starloom.plans.models import dimensions as D
    w = Warehouse(spark, sf_small)
    names = [(r.arena_name, r.arena_city) for r in D.dim_arenas(w.src("arena_mappings"), ordered=True).collect()]
    days = [r.full_date for r in D.dim_dates(w.stg_games, ordered=True).collect()]
    teams = [r.team_abbr for r in D.dim_teams(w.src("team_mappings"), ordered=True).collect()]
    assert names == sorted(names) and days == sorted(days) and teams == sorted(teams) and len(days) > 365
