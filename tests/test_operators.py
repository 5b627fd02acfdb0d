import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.fixed_values import UNION_SOURCE_COLUMN
from starloom.operators import aggregates as A
from starloom.operators import joins as J
from starloom.operators import reshape as R
from starloom.operators import select as S
from starloom.operators import series as G
from starloom.operators.dedupe import Order, deduplicate, first_per_key, latest_per_key
from starloom.operators.ordered import neighbour, replicate


def rows(df, order=None):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: tuple((x is None, x) for x in r))


def test_star_except_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "field_1 int, FIELD_2 int, field_3 int")
    assert df.select(*S.star(df, except_=["field_2"])).columns == ["field_1", "field_3"]
    assert df.select(*S.star(df, prefix="p_", suffix="_s")).columns == ["p_field_1_s", "p_FIELD_2_s", "p_field_3_s"]


def test_nullcheck_and_group_by_n(spark):
    df = spark.createDataFrame([("", 1), ("x", 2), ("", 3)], "s string, n int")
    assert rows(S.nullcheck_table(df)) == [("x", 2), (None, 1), (None, 3)]
    g = S.group_by_n(df, 1, F.count(F.lit(1)).alias("c"))
    assert rows(g) == [("", 2), ("x", 1)]
    with pytest.raises(ValueError):
        S.group_by_n(df, 3)


def test_pivot_counts_else_values(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("M", "red"), ("M", "blue's")], "size string, color string")
    p = R.pivot(df, ["size"], "color", ["red", "blue", "blue's"], agg="count")
    # count of CASE ... ELSE 0 counts every row (the zeros too)
    assert rows(p) == [("M", 2, 2, 2), ("S", 2, 2, 2)]
    p2 = R.pivot(df, ["size"], "color", ["red", "blue"])
    assert rows(p2) == [("M", 1, 0), ("S", 1, 1)]
    p3 = R.pivot(df, ["size"], "color", ["blue's"], quote_identifiers=False)
    assert p3.columns == ["size", "blues"]


def test_unpivot_bool_and_nulls(spark):
    df = spark.createDataFrame([(1, True, None), (2, False, "x")], "id int, flag boolean, name string")
    u = R.unpivot(df, exclude=["id"])
    assert rows(u) == [(1, "flag", "true"), (1, "name", None), (2, "flag", "false"), (2, "name", "x")]
    u2 = R.unpivot(df, exclude=["id"], remove=["NAME"], field_name="f", value_name="v")
    assert u2.columns == ["id", "f", "v"] and u2.count() == 2


def test_union_superset_first_type(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2.5, 7)], "id double, extra int")
    u = R.union_relations({"a": a, "b": b})
    assert u.columns == [UNION_SOURCE_COLUMN, "id", "name", "extra"]
    assert dict(u.dtypes)["id"] == "int"  # first-seen type, no widening
    assert rows(u) == [("a", 1, "x", None), ("b", 2, None, 7)]
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["nope"])


def test_dedupe_nulls_and_ties(spark):
    df = spark.createDataFrame(
        [(1, "old", dt.date(2020, 1, 1)), (1, "new", dt.date(2021, 1, 1)), (1, "nodate", None),
         (2, "b", dt.date(2020, 1, 1)), (2, "a", dt.date(2020, 1, 1))], "id int, name string, d date")
    # DESC puts NULL first, as PostgreSQL does
    assert rows(latest_per_key(df, "id", "d")) == [(1, "nodate", None), (2, "a", dt.date(2020, 1, 1))]
    assert rows(latest_per_key(df, "id", "d", nulls_first=False)) == [
        (1, "new", dt.date(2021, 1, 1)), (2, "a", dt.date(2020, 1, 1))]
    assert rows(first_per_key(df, "id", "d")) == [(1, "old", dt.date(2020, 1, 1)), (2, "a", dt.date(2020, 1, 1))]
    for method in ("aggregate", "window"):
        got = deduplicate(df, ["id"], [Order("d", desc=True, nulls_first=False), Order("name")], method=method)
        assert rows(got) == [(1, "new", dt.date(2021, 1, 1)), (2, "a", dt.date(2020, 1, 1))]


def test_dedupe_text_descending_needs_no_window(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "ab", 2), (1, "", 3), (2, "é", 4), (2, "z", 5), (3, None, 6), (3, "x", 7),
                                (4, "b", -2**63), (4, "b", 2**63 - 1)], "id int, s string, n long")
    for order in ([Order("s", desc=True)], [Order("s", desc=True, nulls_first=False)],
                  [Order("s", desc=True), Order("n", desc=True)], [Order("n", desc=True)]):
        a, b = deduplicate(df, ["id"], order), deduplicate(df, ["id"], order, method="window")
        assert rows(a) == rows(b)
        assert "Window" not in a._jdf.queryExecution().optimizedPlan().toString()


def test_date_spine_end_excluded(spark):
    b = spark.createDataFrame([(dt.date(2018, 1, 1), dt.date(2018, 1, 10))], "s date, e date")
    days = [r[0] for r in G.date_spine(b, "s", "e", "day").orderBy("date_day").collect()]
    assert days[0] == dt.date(2018, 1, 1) and days[-1] == dt.date(2018, 1, 9) and len(days) == 9
    m = spark.createDataFrame([(dt.date(2018, 1, 15), dt.date(2018, 3, 20))], "s date, e date")
    assert [r[0] for r in G.date_spine(m, "s", "e", "month").orderBy("date_month").collect()] == [
        dt.date(2018, 1, 15), dt.date(2018, 2, 15)]


def test_generate_series_and_single_value(spark):
    assert [r[0] for r in G.generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        G.generate_series(spark, 0)
    empty = spark.createDataFrame([], "x int")
    assert G.single_value(empty, default=-1).collect()[0][0] == -1
    one = spark.createDataFrame([(6,)], "x int")
    assert G.single_value(one).collect()[0][0] == 6


def test_column_values_topk(spark):
    df = spark.createDataFrame([(v,) for v in "aabbbcd"], "v string")
    assert rows(A.column_values(df, "v", max_records=2)) == [("a", 2), ("b", 3)]
    assert A.column_values_list(df, "v", max_records=10) == ["b", "a", "c", "d"]
    assert A.column_values_list(df, "v", max_records=2) == ["b", "a"]  # a limit, not an error
    assert rows(A.column_values(df.limit(0), "v", default=["x", "y"])) == [("x", None), ("y", None)]
    assert len(rows(A.column_values(df, "v", default=["x"]))) == 4


def test_lookup_plain_equality_and_natural_join(spark):
    fact = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    dim = spark.createDataFrame([(1, "one"), (None, "null-row")], "k int, label string")
    out = J.lookup(fact, dim, [("k", "k")], [("label", "label")])
    assert rows(out) == [(1, "x", "one"), (None, "y", None)]  # NULL never matches
    assert rows(J.natural_join(fact, dim)) == [(1, "x", "one")]


def test_other_side_matches_self_join(spark):
    df = spark.createDataFrame(
        [("g1", "A", 10), ("g1", "B", 20), ("g2", "A", 1), ("g2", "B", 2), ("g2", "C", 3),
         ("g3", "A", 5), ("g3", "A", 6), ("g4", "A", 9)], "g string, team string, pts int")
    fast = J.other_side(df, ["g"], "team", ["pts"], prefix="o_")
    b = df.select(F.col("g").alias("bg"), F.col("team").alias("o_team"), F.col("pts").alias("o_pts"))
    slow = df.join(b, (F.col("g") == F.col("bg")) & (F.col("team") != F.col("o_team"))).drop("bg")
    assert rows(fast) == rows(slow)


def test_neighbour_equals_global_window(spark):
    import random
    from pyspark.sql import Window
    random.seed(7)
    data = [(random.choice(["p", "q", None]), i * 3 + random.randint(0, 2)) for i in range(400)]
    data += [("p", None), (None, None)]
    df = spark.createDataFrame(data, "p string, v int").dropDuplicates()
    for direction, fn in (("prev", F.lag), ("next", F.lead)):
        got = neighbour(df, ["p"], ["v"], "v", direction, "nb", rows_per_range=2)
        w = Window.partitionBy("p").orderBy(F.col("v").asc_nulls_last())
        want = df.withColumn("nb", fn("v").over(w)).withColumn("nb_exists", fn(F.lit(True)).over(w).isNotNull())
        assert rows(got.select("p", "v", "nb", "nb_exists")) == rows(want.select("p", "v", "nb", "nb_exists"))


def test_replicate(spark):
    df = spark.createDataFrame([("a", 3), ("b", 0), ("c", 70000)], "k string, n long")
    out = replicate(df, "n").groupBy("k").count()
    assert rows(out) == [("a", 3), ("c", 70000)]


def test_seed_csv_and_catalog_prefix(spark, tmp_path):
    from starloom.sources.catalog import tables_by_pattern, tables_by_prefix, union_by_pattern
    from starloom.sources.tables import read_seed_csv
    p = tmp_path / "team_mappings.csv"
    p.write_text("team_abbr,full_name\nT1,One\nT2,Two\n")
    seed = read_seed_csv(spark, str(p), "team_abbr string, full_name string")
    assert rows(seed) == [("T1", "One"), ("T2", "Two")]
    seed.createOrReplaceTempView("data_events_20180101")
    seed.createOrReplaceTempView("data_events_20180102")
    seed.createOrReplaceTempView("data_eventsX20180103")
    assert tables_by_prefix(spark, "data_events_") == ["data_events_20180101", "data_events_20180102"]
    assert len(tables_by_pattern(spark, "DATA\\_EVENTS\\_%", exclude="%0102")) == 1
    assert union_by_pattern(spark, "data_events%").count() == 6


def test_date_spine_parts(spark):
    b = spark.createDataFrame([(dt.date(2018, 1, 31), dt.date(2019, 7, 1))], "s date, e date")
    q = [r[0] for r in G.date_spine(b, "s", "e", "quarter").orderBy("date_quarter").collect()]
    assert q == [dt.date(2018, 1, 31), dt.date(2018, 4, 30), dt.date(2018, 7, 31), dt.date(2018, 10, 31),
                 dt.date(2019, 1, 31), dt.date(2019, 4, 30)]
    y = [r[0] for r in G.date_spine(b, "s", "e", "year").collect()]
    assert y == [dt.date(2018, 1, 31)]
    w = G.date_spine(b, "s", "e", "week")
    assert w.count() == (dt.date(2019, 7, 1) - dt.date(2018, 1, 31)).days // 7
    h = spark.createDataFrame([(dt.datetime(2018, 1, 1, 22), dt.datetime(2018, 1, 2, 3))], "s timestamp_ntz, e timestamp_ntz")
    assert G.date_spine(h, "s", "e", "hour").count() == 5


def test_ordered_dimensions(spark, sf_small):
    from starloom.plans.models.dimensions import dim_teams
    from starloom.plans.raw import Raw
    teams = dim_teams(Raw(spark, sf_small).team_mappings, ordered=True)
    codes = [r.team_abbr for r in teams.collect()]
    assert codes == sorted(codes)


def test_neighbour_split_on_timestamps(spark):
    from pyspark.sql import Window
    base = dt.datetime(2024, 1, 1)
    data = [("a", base + dt.timedelta(minutes=7 * i)) for i in range(60)]
    df = spark.createDataFrame(data, "p string, ts timestamp_ntz")
    got = neighbour(df, ["p"], ["ts"], "ts", "prev", "nb", rows_per_range=2)
    w = Window.partitionBy("p").orderBy("ts")
    want = df.withColumn("nb", F.lag("ts").over(w))
    assert rows(got.select("p", "ts", "nb")) == rows(want.select("p", "ts", "nb"))


def test_api_variants(spark):
    from starloom.operators import quality as Q
    df = spark.createDataFrame([("S", "red"), ("S", "red"), ("M", "blue")], "size string, color string")
    p = R.pivot(df, ["size"], "color")  # values read from the data
    assert sorted(p.columns) == ["blue", "red", "size"]
    df.createOrReplaceTempView("colors_a")
    assert R.union_relations(["colors_a", ("other", df)]).count() == 6
    r = spark.createDataFrame([(1, 0, 5), (1, 3, 8), (2, 0, 5)], "g int, lo int, hi int")
    assert Q.mutually_exclusive_ranges(r, "lo", "hi", partition_by="g").failures.count() == 1
    assert Q.mutually_exclusive_ranges(r, "lo", "hi", partition_by="g * 0").failures.count() == 2
