"""Registered queries of the operators that exist for size: versioned and bucketed
layers, checks from states and during writes, digests, sketches, exact quantiles,
file unions, generated series."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import functions as X
from ..fixed_values import UNION_SOURCE_COLUMN
from ..operators import aggregates as A
from ..operators import check_states as C
from ..operators import quality as Q
from ..operators import series as G
from ..operators.quantiles import quantile_columns
from ..session import ensure_checkpoint_dir
from ..sources.catalog import union_by_pattern_files
from ..sources.sinks import (incremental_refresh, read_layer, upsert_partitions, with_load_time, write_bucketed,
                             write_checked, write_layer)
from ..sources.tables import Tables
from .layers import Warehouse
from .models import dimensions as D
from .oracle_models import model_sql, with_models
from .q_checks import _CUST_B_SQL, _cust_pair
from .raw import Raw
from .registry import query


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------- S4, S6, F23, O1
@query("table_sink_switch", """
SELECT 'after_a_broken_refresh' AS seen, o_orderkey, o_totalprice AS amount FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'after_a_refresh', o_orderkey, o_totalprice + 1 FROM orders""")
def q_table_sink_switch(spark, d):
    """A refresh that fails on a row leaves the table; the next one replaces it."""
    o = Tables(spark, d).orders
    path = _scratch(spark, "switch")
    write_layer(o.where("o_orderstatus <> 'P'").select("o_orderkey", F.col("o_totalprice").alias("amount")), path)
    fails = F.when(F.col("o_orderstatus") == "P", F.raise_error(F.lit("a row that cannot be written")).cast("double")).otherwise(F.lit(0.0))
    try:
        write_layer(o.select("o_orderkey", fails.alias("amount")), path)
    except Exception as e:
        if "a row that cannot be written" not in str(e):
            raise
    before = read_layer(spark, path)
    write_layer(o.select("o_orderkey", (F.col("o_totalprice") + 1).alias("amount")), path)
    return (before.select(F.lit("after_a_broken_refresh").alias("seen"), "o_orderkey", "amount")
            .unionByName(read_layer(spark, path).select(F.lit("after_a_refresh").alias("seen"), "o_orderkey", "amount")))


@query("load_time", "SELECT count(*) AS n_rows, count(*) AS n_stamped, 1::BIGINT AS n_stamps, true AS is_recent FROM orders")
def q_load_time(spark, d):
    """Every row of a written layer carries the load time of its run."""
    path = _scratch(spark, "loaded")
    write_layer(with_load_time(Tables(spark, d).orders.select("o_orderkey")), path)
    return read_layer(spark, path).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("loaded_at").alias("n_stamped"), F.count_distinct("loaded_at").alias("n_stamps"),
        (F.max("loaded_at") > F.current_timestamp() - F.expr("INTERVAL 1 HOUR")).alias("is_recent"))


@query("final_sort", with_models("""
SELECT row_number() OVER (ORDER BY team_abbr) AS position, team_abbr FROM dim_teams"""))
def q_final_sort(spark, d):
    """The place of each row in a dimension's final order (O1)."""
    rows = D.dim_teams(Warehouse(spark, d).src("team_mappings"), ordered=True).select("team_abbr", F.monotonically_increasing_id().alias("__at"))
    return rows.select(F.row_number().over(Window.orderBy("__at")).cast("long").alias("position"), "team_abbr")


@query("dq_observed_write", """
SELECT 'accepted_range' AS check_name, count(*) AS failures FROM orders WHERE o_totalprice < 5000
UNION ALL SELECT 'not_null', count(*) FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT 'expression_is_true', count(*) FROM orders WHERE NOT (o_orderkey % 3 > 0)
UNION ALL SELECT 'unique', count(*) FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1)""")
def q_dq_observed_write(spark, d):
    """Row checks counted while the layer is written; a check of groups after it."""
    rows = Tables(spark, d).orders.withColumn("urgency", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    checks = [Q.accepted_range(rows, "o_totalprice", 5000), Q.not_null(rows, "urgency"),
              Q.expression_is_true(rows, "o_orderkey % 3 > 0"), Q.unique(rows, "o_custkey")]
    return write_checked(rows, _scratch(spark, "observed"), checks).select("check_name", "failures")


# ---------------------------------------------------------- Q2, Q8, Q10, Q11, Q16
_AFTER = """
WITH t AS (
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE NULL END AS flag, o_custkey,
           CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS amount, 7 AS fixed, CAST(o_orderdate AS DATE) AS order_date
    FROM orders)"""


@query("dq_suite_incremental", _AFTER + """
SELECT 'at_least_one' AS check_name, CAST(CASE WHEN count(flag) = 0 THEN 1 ELSE 0 END AS BIGINT) AS failures FROM t
UNION ALL SELECT 'not_constant', CAST(CASE WHEN count(DISTINCT fixed) = 1 THEN 1 ELSE 0 END AS BIGINT) FROM t
UNION ALL SELECT 'not_null_proportion', CAST(CASE WHEN count(amount) / count(*) < 0.995 THEN 1 ELSE 0 END AS BIGINT) FROM t
UNION ALL SELECT 'recency', CAST(CASE WHEN max(order_date) < TIMESTAMP '2001-01-01' THEN 1 ELSE 0 END AS BIGINT) FROM t
UNION ALL SELECT 'unique_combination_of_columns', count(*) FROM (SELECT o_custkey, order_date FROM t GROUP BY ALL HAVING count(*) > 1)""")
def q_dq_suite_incremental(spark, d):
    """The suite after an upsert: only the touched months are read again."""
    rows = Tables(spark, d).orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", 1.0).alias("flag"), "o_custkey",
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_totalprice")).alias("amount"), F.lit(7).alias("fixed"),
        F.col("o_orderdate").cast("date").alias("order_date"))
    path = _scratch(spark, "states")
    recent = F.col("order_date") >= F.lit("2001-06-01").cast("date")
    old = rows.withColumn("amount", F.when(~recent, F.col("amount"))).where(~(recent & (F.col("o_orderkey") % 2 == 0)))
    checks = [C.at_least_one("flag"), C.not_constant("fixed"), C.not_null_proportion("amount", 0.995),
              C.recency("order_date", "day", 0, "2001-01-01 00:00:00"), C.unique_combination("o_custkey", "order_date")]
    incremental_refresh(spark, path, lambda since: old, "o_orderkey", "order_date")
    C.run_state_checks(spark, path, checks)
    upsert_partitions(spark, path, rows.where(recent), "o_orderkey", "order_date")
    return C.run_state_checks(spark, path, checks)[0].select("check_name", "failures")


# --------------------------------------------------------------- Q3, Q5, T2
@query("dq_equality_digest", f"""
WITH a AS (SELECT c_custkey, c_name, c_acctbal FROM customer), b AS ({_CUST_B_SQL})
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) x
UNION ALL SELECT 'b_minus_a' AS which_diff, * FROM (SELECT * FROM b EXCEPT SELECT * FROM a) y""")
def q_dq_equality_digest(spark, d):
    """Only buckets whose digests differ are compared; repeats make no difference."""
    a, b = _cust_pair(spark, d)
    repeated = a.where(F.col("c_custkey") % 10 == 0)
    return Q.equality(a.unionByName(repeated), b, digest_buckets=4096).failures


# ----------------------------------------------------------------- A6, O2, A5
@query("column_values_topk_large", """
SELECT * FROM (SELECT 'o_orderkey' AS col, CAST(o_orderkey AS VARCHAR) AS value, count(*) AS ordering FROM orders GROUP BY o_orderkey ORDER BY 3 DESC, o_orderkey LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'l_shipdate', strftime(l_shipdate, '%Y-%m-%d'), count(*) FROM lineitem GROUP BY l_shipdate ORDER BY 3 DESC, l_shipdate LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'p_type', p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY 3 DESC, p_type LIMIT 3)""")
def q_column_values_topk_large(spark, d):
    """Most frequent values by sketches: of a column with as many values as rows (counted
    in full, since nothing can be proven of ties), and of columns with fewer."""
    t = Tables(spark, d)

    def of(df, column, k, text):
        return A.top_values(df, column, k).select(F.lit(column).alias("col"), text.alias("value"), "ordering")

    return (of(t.orders, "o_orderkey", 10, F.col("o_orderkey").cast("string"))
            .unionByName(of(t.lineitem, "l_shipdate", 10, F.date_format("l_shipdate", "yyyy-MM-dd")))
            .unionByName(of(t.part, "p_type", 3, F.col("p_type"))))


# ----------------------------------------------------------------- S7, T1
@query("union_by_pattern_files", f"""
SELECT 'nation' AS {UNION_SOURCE_COLUMN}, n_nationkey, n_name, n_regionkey, CAST(NULL AS INTEGER) AS r_regionkey, CAST(NULL AS VARCHAR) AS r_name FROM nation
UNION ALL SELECT 'region', NULL, NULL, NULL, r_regionkey, r_name FROM region""")
def q_union_by_pattern_files(spark, d):
    """All matching tables in one scan."""
    return union_by_pattern_files(spark, d, "%ion")


# ----------------------------------------------------------------- P7
@query("quartile_labels_from_data", """
WITH c AS (SELECT quantile_disc(l_extendedprice, 0.25) AS q1, quantile_disc(l_extendedprice, 0.5) AS q2, quantile_disc(l_extendedprice, 0.75) AS q3,
                  quantile_disc(l_extendedprice, 0.999) AS top FROM lineitem)
SELECT CASE WHEN l_extendedprice < q1 THEN 'Q1' WHEN l_extendedprice < q2 THEN 'Q2' WHEN l_extendedprice < q3 THEN 'Q3' ELSE 'Q4' END AS label,
       l_extendedprice >= top AS is_top, count(*) AS n, min(l_extendedprice) AS low, max(l_extendedprice) AS high
FROM lineitem, c GROUP BY ALL""")
def q_quartile_labels_from_data(spark, d):
    """Tiers whose thresholds are the exact quantiles of the column."""
    li = Tables(spark, d).lineitem
    *cuts, top = quantile_columns(li, "l_extendedprice", [0.25, 0.5, 0.75, 0.999])
    price = F.col("l_extendedprice")
    return (li.select(X.quartile_label("l_extendedprice", cuts).alias("label"), (price >= top).alias("is_top"), "l_extendedprice")
            .groupBy("label", "is_top").agg(F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")))


# ----------------------------------------------------------------- G1
@query("date_spine_second", """
SELECT CAST(d AS TIMESTAMP) AS date_second FROM (SELECT min(o_orderdate) AS lo FROM orders) b,
  generate_series(b.lo, b.lo + INTERVAL 2 DAY - INTERVAL 1 SECOND, INTERVAL 1 SECOND) t(d)""")
def q_date_spine_second(spark, d):
    """A long series, made in chunks."""
    lo = F.min("o_orderdate")
    bounds = Tables(spark, d).orders.agg(lo.alias("lo"), (lo + F.expr("INTERVAL 2 DAYS")).alias("hi"))
    return G.date_spine(bounds, "lo", "hi", "second")


# ------------------------------------------------------------- J2, J8, M8, M9
#: Lines of one bucket: a task sorts them in memory before it writes them.
BUCKET_LINES = 400_000


def bucketed_warehouse(spark, d, buckets: int | None = None) -> Warehouse:
    """The warehouse on staging layers that are written in buckets of game_id, eight
    or as many as the number of lines asks for (counted from the files' footers). The
    raw rows are dealt out to the buckets, so that no layer is shuffled to be written."""
    t = Tables(spark, d)
    buckets = buckets or max(8, -(-max(t.orders.count(), t.lineitem.count()) // BUCKET_LINES))
    w = Warehouse(spark, d, raw=Raw(spark, d, buckets))
    names = ["stg_games", "stg_player_game_basic_stats", "stg_player_game_adv_stats_extended", "stg_player_game_adv_stats",
             "stg_team_game_basic_stats", "stg_team_game_adv_stats"]
    for name in names:
        table = f"starloom_{name}_{uuid.uuid4().hex[:12]}"
        w.use(name, write_bucketed(getattr(w, name), table, _scratch(spark, table), ["game_id"], buckets))
    return w


@query("int_player_performance_bucketed", model_sql("int_player_performance"))
def q_int_player_performance_bucketed(spark, d):
    return bucketed_warehouse(spark, d).int_player_performance


@query("int_team_performance_bucketed", model_sql("int_team_performance"))
def q_int_team_performance_bucketed(spark, d):
    return bucketed_warehouse(spark, d).int_team_performance
