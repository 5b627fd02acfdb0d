"""Data-quality checks as registered queries: each returns its failing rows.

Every check is set up so that it *does* find failures on the test tables
(the must-fail case); the passing cases are covered by the unit tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..fixed_values import EQUAL_ROWCOUNT_ID, FEWER_ROWS_THAN_ID
from ..operators import quality as Q
from ..sources.tables import Tables
from .registry import query


@query("dq_accepted_range", """
SELECT * FROM orders WHERE NOT (o_totalprice >= 5000) OR NOT (o_totalprice <= 400000)
""")
def q_dq_accepted_range(spark, d):
    return Q.accepted_range(Tables(spark, d).orders, "o_totalprice", 5000, 400000).failures


_EV_SIGNUP_NULL = ("SELECT event_type, CASE WHEN event_type = 'signup' THEN NULL ELSE value END AS value "
                   "FROM events")


def _ev_signup_null(spark, d):
    ev = Tables(spark, d).events
    return ev.select("event_type", F.when(F.col("event_type") == "signup", F.lit(None))
                     .otherwise(F.col("value")).alias("value"))


@query("dq_at_least_one", f"""
SELECT event_type, count(value) AS filler_column FROM ({_EV_SIGNUP_NULL}) t
GROUP BY event_type HAVING count(value) = 0
""")
def q_dq_at_least_one(spark, d):
    return Q.at_least_one(_ev_signup_null(spark, d), "value", group_by=["event_type"]).failures


@query("dq_at_least_one_ungrouped", f"""
SELECT count(value) AS filler_column
FROM (SELECT value FROM ({_EV_SIGNUP_NULL}) t WHERE event_type = 'signup' AND value IS NOT NULL LIMIT 1) p
HAVING count(value) = 0
""")
def q_dq_at_least_one_ungrouped(spark, d):
    t = _ev_signup_null(spark, d)
    return Q.at_least_one(t, "value", where=F.col("event_type") == "signup").failures


@query("dq_cardinality_equality", """
WITH a AS (SELECT o_custkey, count(*) AS num_rows FROM orders GROUP BY o_custkey),
     b AS (SELECT c_custkey AS o_custkey, count(*) AS num_rows FROM customer GROUP BY c_custkey)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)
""")
def q_dq_cardinality_equality(spark, d):
    t = Tables(spark, d)
    return Q.cardinality_equality(t.orders, "o_custkey", t.customer, "c_custkey").failures


@query("dq_equal_rowcount", f"""
WITH a AS (SELECT o_orderstatus, 1 AS id, count(*) AS count_a FROM orders GROUP BY o_orderstatus),
     b AS (SELECT o_orderstatus, 1 AS id, count(*) AS count_b FROM orders
           WHERE o_totalprice >= 10000 AND o_orderstatus <> 'P' GROUP BY o_orderstatus)
SELECT a.id AS {EQUAL_ROWCOUNT_ID}_a, b.id AS {EQUAL_ROWCOUNT_ID}_b,
       a.o_orderstatus AS o_orderstatus_a, b.o_orderstatus AS o_orderstatus_b,
       count_a, count_b, abs(count_a - count_b) AS diff_count
FROM a FULL JOIN b ON a.id = b.id AND a.o_orderstatus = b.o_orderstatus
""")
def q_dq_equal_rowcount(spark, d):
    o = Tables(spark, d).orders
    other = o.filter((F.col("o_totalprice") >= 10000) & (F.col("o_orderstatus") != "P"))
    return Q.equal_rowcount(o, other, group_by=["o_orderstatus"]).failures


@query("dq_fewer_rows_than", f"""
WITH a AS (SELECT o_orderpriority, 1 AS id, count(*) AS count_our_model FROM orders
           WHERE o_orderstatus = 'F' GROUP BY o_orderpriority),
     b AS (SELECT o_orderpriority, 1 AS id, count(*) AS count_comparison_model FROM orders
           WHERE o_orderstatus = 'O' AND o_orderpriority <> '2-HIGH' GROUP BY o_orderpriority)
SELECT a.id AS {FEWER_ROWS_THAN_ID}_a, b.id AS {FEWER_ROWS_THAN_ID}_b,
       a.o_orderpriority AS o_orderpriority_a, b.o_orderpriority AS o_orderpriority_b,
       count_our_model, count_comparison_model,
       CASE WHEN count_our_model > count_comparison_model THEN count_our_model - count_comparison_model
            WHEN count_our_model = count_comparison_model THEN 1 ELSE 0 END AS row_count_delta
FROM a FULL JOIN b ON a.id = b.id AND a.o_orderpriority = b.o_orderpriority
""")
def q_dq_fewer_rows_than(spark, d):
    o = Tables(spark, d).orders
    a = o.filter(F.col("o_orderstatus") == "F")
    b = o.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") != "2-HIGH"))
    return Q.fewer_rows_than(a, b, group_by=["o_orderpriority"]).failures


_CUST_B_SQL = """SELECT c_custkey,
  CASE WHEN c_custkey % 77 = 0 THEN c_name || 'x' ELSE c_name END AS c_name,
  CASE WHEN c_custkey % 50 = 0 THEN c_acctbal + 0.001 WHEN c_custkey % 60 = 0 THEN c_acctbal + 0.5 ELSE c_acctbal END AS c_acctbal
FROM customer"""


def _cust_pair(spark, d):
    c = Tables(spark, d).customer
    a = c.select("c_custkey", "c_name", "c_acctbal")
    k = F.col("c_custkey")
    b = c.select("c_custkey",
                 F.when(k % 77 == 0, F.concat(F.col("c_name"), F.lit("x"))).otherwise(F.col("c_name")).alias("c_name"),
                 F.when(k % 50 == 0, F.col("c_acctbal") + 0.001).when(k % 60 == 0, F.col("c_acctbal") + 0.5)
                 .otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    return a, b


@query("dq_equality", f"""
WITH a AS (SELECT c_custkey, c_name, c_acctbal FROM customer), b AS ({_CUST_B_SQL})
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) x
UNION ALL SELECT 'b_minus_a' AS which_diff, * FROM (SELECT * FROM b EXCEPT SELECT * FROM a) y
""")
def q_dq_equality(spark, d):
    a, b = _cust_pair(spark, d)
    return Q.equality(a, b).failures


@query("dq_equality_precision", f"""
WITH a AS (SELECT c_custkey, c_name, round(CAST(c_acctbal AS DECIMAL(38, 10)), 2) AS c_acctbal FROM customer),
     b AS (SELECT c_custkey, c_name, round(CAST(c_acctbal AS DECIMAL(38, 10)), 2) AS c_acctbal FROM ({_CUST_B_SQL}) t)
SELECT 'a_minus_b' AS which_diff, c_custkey, c_acctbal FROM (SELECT c_custkey, c_acctbal FROM a EXCEPT SELECT c_custkey, c_acctbal FROM b) x
UNION ALL SELECT 'b_minus_a' AS which_diff, c_custkey, c_acctbal FROM (SELECT c_custkey, c_acctbal FROM b EXCEPT SELECT c_custkey, c_acctbal FROM a) y
""")
def q_dq_equality_precision(spark, d):
    a, b = _cust_pair(spark, d)
    out = Q.equality(a, b, compare_columns=["c_custkey", "C_ACCTBAL"], precision=2).failures
    return out.select("which_diff", "c_custkey", F.col("c_acctbal").cast("decimal(38,2)").alias("c_acctbal"))


@query("dq_expression_is_true", """
SELECT * FROM lineitem WHERE NOT (l_extendedprice > 0 AND l_discount <= 0.09)
""")
def q_dq_expression_is_true(spark, d):
    return Q.expression_is_true(Tables(spark, d).lineitem,
                                "l_extendedprice > 0 AND l_discount <= 0.09").failures


def _ranges_sql(part_sql: str, lo: str, hi: str, src: str, gap_op: str, gap_words: str,
                zl_op: str = "<", zl_words: str = "less_than") -> str:
    p = f"PARTITION BY {part_sql}" if part_sql else ""
    pcol = f"{part_sql} AS partition_by_col, " if part_sql else ""
    return f"""
WITH w AS (
  SELECT {pcol}{lo} AS lower_bound, {hi} AS upper_bound,
    lead({lo}) OVER ({p} ORDER BY {lo} ASC NULLS LAST, {hi} ASC NULLS LAST) AS next_lower_bound,
    row_number() OVER ({p} ORDER BY {lo} ASC NULLS LAST, {hi} ASC NULLS LAST)
      = count(*) OVER ({p.replace('PARTITION BY', 'PARTITION BY') if p else ''}) AS is_last_record
  FROM {src}),
c AS (
  SELECT *, coalesce(lower_bound {zl_op} upper_bound, false) AS lower_bound_{zl_words}_upper_bound,
         coalesce(upper_bound {gap_op} next_lower_bound, is_last_record, false) AS upper_bound_{gap_words}_next_lower_bound
  FROM w)
SELECT * FROM c WHERE NOT (lower_bound_{zl_words}_upper_bound AND upper_bound_{gap_words}_next_lower_bound)
"""


_ORDER_RANGES = ("(SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, "
                 "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS valid_to FROM orders) r")


@query("dq_mutually_exclusive_ranges", _ranges_sql("o_custkey", "valid_from", "valid_to", _ORDER_RANGES,
                                                   "<=", "less_than_or_equal_to"))
def q_dq_mutually_exclusive_ranges(spark, d):
    o = Tables(spark, d).orders
    r = o.select("o_custkey", F.col("o_orderdate").cast("date").alias("valid_from"),
                 F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 40).cast("int"))
                 .alias("valid_to"))
    return Q.mutually_exclusive_ranges(r, "valid_from", "valid_to", partition_by="o_custkey").failures


_GLOBAL_RANGES = ("(SELECT o_orderkey * 10 AS lo, o_orderkey * 10 + o_orderkey % 12 AS hi FROM orders "
                  "UNION ALL SELECT o_orderkey * 10, o_orderkey * 10 + o_orderkey % 12 FROM orders "
                  "WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') r")


@query("dq_mutually_exclusive_ranges_global",
       _ranges_sql("", "lo", "hi", _GLOBAL_RANGES, "=", "equal_to"))
def q_dq_mutually_exclusive_ranges_global(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey")
    r = o.select((k * 10).alias("lo"), (k * 10 + k % 12).alias("hi"))
    dup = o.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"))
    r = r.unionByName(dup.select((k * 10).alias("lo"), (k * 10 + k % 12).alias("hi")))
    return Q.mutually_exclusive_ranges(r, "lo", "hi", gaps="not_allowed").failures


@query("dq_not_constant", """
SELECT o_orderstatus, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderpriority END) AS filler_column
FROM orders GROUP BY o_orderstatus
HAVING count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderpriority END) = 1
""")
def q_dq_not_constant(spark, d):
    o = Tables(spark, d).orders
    t = o.select("o_orderstatus", F.when(F.col("o_orderstatus") == "F", "X")
                 .otherwise(F.col("o_orderpriority")).alias("prio"))
    return Q.not_constant(t, "prio", group_by=["o_orderstatus"]).failures


@query("dq_not_accepted_values", """
SELECT value_field FROM (SELECT DISTINCT o_orderpriority AS value_field FROM orders) v
WHERE value_field IN ('5-LOW', '9-NONE')
""")
def q_dq_not_accepted_values(spark, d):
    return Q.not_accepted_values(Tables(spark, d).orders, "o_orderpriority", ["5-LOW", "9-NONE"]).failures


@query("dq_not_null_proportion", """
WITH t AS (SELECT event_type, CASE WHEN event_id % 7 = 0 OR (event_type = 'error' AND event_id % 2 = 0)
                                   THEN NULL ELSE value END AS value FROM events),
v AS (SELECT event_type, CAST(sum(CASE WHEN value IS NULL THEN 0 ELSE 1 END) AS DOUBLE) / CAST(count(*) AS DOUBLE)
          AS not_null_proportion FROM t GROUP BY event_type)
SELECT * FROM v WHERE not_null_proportion < 0.8 OR not_null_proportion > 1
""")
def q_dq_not_null_proportion(spark, d):
    ev = Tables(spark, d).events
    t = ev.select("event_type", F.when((F.col("event_id") % 7 == 0)
                                       | ((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0)),
                                       F.lit(None)).otherwise(F.col("value")).alias("value"))
    return Q.not_null_proportion(t, "value", at_least=0.8, group_by=["event_type"]).failures


@query("dq_recency", """
WITH t AS (SELECT * FROM events WHERE NOT (event_type = 'error' AND ts > TIMESTAMP '2024-01-20 00:00:00')),
r AS (SELECT event_type, max(ts) AS most_recent FROM t GROUP BY event_type)
SELECT event_type, most_recent, TIMESTAMP '2024-01-31 06:00:00' - INTERVAL 3 DAY AS threshold
FROM r WHERE most_recent < TIMESTAMP '2024-01-31 06:00:00' - INTERVAL 3 DAY
""")
def q_dq_recency(spark, d):
    ev = Tables(spark, d).events
    t = ev.filter(~((F.col("event_type") == "error") & (F.col("ts") > F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))))
    return Q.recency(t, "ts", "day", 3, now="2024-01-31 06:00:00", group_by=["event_type"]).failures


@query("dq_relationships_where", """
SELECT l.id, CAST(NULL AS BIGINT) AS right_id
FROM (SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL) l
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_mktsegment <> 'BUILDING' AND c.c_custkey IS NOT NULL AND c.c_custkey = l.id)
""")
def q_dq_relationships_where(spark, d):
    t = Tables(spark, d)
    return Q.relationships_where(t.orders, "o_custkey", t.customer, "c_custkey",
                                 from_condition="o_orderstatus = 'F'",
                                 to_condition="c_mktsegment <> 'BUILDING'").failures


@query("dq_not_empty_string", """
SELECT trim(CASE WHEN c_custkey % 11 = 0 THEN '   ' WHEN c_custkey % 13 = 0 THEN '' ELSE c_name END) AS c_name
FROM customer
WHERE trim(CASE WHEN c_custkey % 11 = 0 THEN '   ' WHEN c_custkey % 13 = 0 THEN '' ELSE c_name END) = ''
""")
def q_dq_not_empty_string(spark, d):
    c = Tables(spark, d).customer
    k = F.col("c_custkey")
    t = c.select(F.when(k % 11 == 0, "   ").when(k % 13 == 0, "").otherwise(F.col("c_name")).alias("c_name"))
    return Q.not_empty_string(t, "c_name").failures


@query("dq_sequential_values", """
WITH w AS (SELECT l_orderkey, l_linenumber,
                  lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous_l_linenumber
           FROM lineitem)
SELECT * FROM w WHERE NOT (l_linenumber = previous_l_linenumber + 1)
""")
def q_dq_sequential_values(spark, d):
    li = Tables(spark, d).lineitem
    return Q.sequential_values(li, "l_linenumber", group_by=["l_orderkey"]).failures


@query("dq_sequential_values_global", """
WITH t AS (SELECT 2 * o_orderkey + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS step_key FROM orders),
w AS (SELECT step_key, lag(step_key) OVER (ORDER BY step_key) AS previous_step_key FROM t)
SELECT * FROM w WHERE NOT (step_key = previous_step_key + 2)
""")
def q_dq_sequential_values_global(spark, d):
    key = 2 * F.col("o_orderkey") + F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    return Q.sequential_values(Tables(spark, d).orders.select(key.alias("step_key")), "step_key", interval=2).failures


@query("dq_sequential_dates", """
WITH t AS (SELECT CAST(o_orderdate AS DATE) AS order_day FROM orders),
w AS (SELECT order_day, lag(order_day) OVER (ORDER BY order_day) AS previous_order_day FROM t)
SELECT * FROM w WHERE NOT (CAST(order_day AS TIMESTAMP) = CAST(previous_order_day + INTERVAL 1 DAY AS TIMESTAMP))
""")
def q_dq_sequential_dates(spark, d):
    t = Tables(spark, d).orders.select(F.col("o_orderdate").cast("date").alias("order_day"))
    return Q.sequential_values(t, "order_day", datepart="day").failures


@query("dq_unique_combination", """
SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def q_dq_unique_combination(spark, d):
    return Q.unique_combination_of_columns(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"]).failures


@query("dq_unique", """
SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey HAVING count(*) > 1
""")
def q_dq_unique(spark, d):
    return Q.unique(Tables(spark, d).orders, "o_custkey").failures


@query("dq_not_null", """
SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_custkey END AS o_custkey FROM orders) t
WHERE o_custkey IS NULL
""")
def q_dq_not_null(spark, d):
    o = Tables(spark, d).orders
    t = o.select("o_orderkey", F.when(F.col("o_orderkey") % 37 != 0, F.col("o_custkey")).alias("o_custkey"))
    return Q.not_null(t, "o_custkey").failures


@query("dq_relationships", """
SELECT l_partkey AS from_field FROM lineitem l
WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_size <= 45 AND p.p_partkey = l.l_partkey)
""")
def q_dq_relationships(spark, d):
    t = Tables(spark, d)
    return Q.relationships(t.lineitem, "l_partkey", t.part.filter(F.col("p_size") <= 45),
                           "p_partkey").failures


@query("dq_accepted_values", """
SELECT o_orderstatus AS value_field, count(*) AS n_records FROM orders
GROUP BY o_orderstatus HAVING NOT coalesce(o_orderstatus IN ('F', 'O'), false)
""")
def q_dq_accepted_values(spark, d):
    return Q.accepted_values(Tables(spark, d).orders, "o_orderstatus", ["F", "O"]).failures


@query("dq_assert_equal", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  coalesce(l_linenumber, 0) + coalesce(l_partkey % 10, 0) AS actual,
                  l_linenumber + l_partkey % 10 + CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END AS expected
           FROM lineitem)
SELECT * FROM t WHERE actual <> expected
""")
def q_dq_assert_equal(spark, d):
    li = Tables(spark, d).lineitem
    t = li.select("l_orderkey", "l_linenumber", "l_partkey",
                  X.safe_add("l_linenumber", F.col("l_partkey") % 10).alias("actual"),
                  (F.col("l_linenumber") + F.col("l_partkey") % 10
                   + F.when(F.col("l_orderkey") % 97 == 0, 1).otherwise(0)).alias("expected"))
    return Q.assert_equal(t, "actual", "expected").failures


@query("dq_columns_match", """
WITH r AS (SELECT upper(column_name) AS relation_column FROM information_schema.columns WHERE table_name = 'customer'),
i AS (SELECT unnest(['C_CUSTKEY', 'C_NAME', 'C_PHONE']) AS input_column)
SELECT relation_column, input_column FROM r FULL OUTER JOIN i ON r.relation_column = i.input_column
WHERE r.relation_column IS NULL OR i.input_column IS NULL
""")
def q_dq_columns_match(spark, d):
    return Q.columns_match_set(spark, Tables(spark, d).customer, ["C_CUSTKEY", "c_name", "c_phone"]).failures


@query("dq_suite", """
SELECT 0 AS check_index, 'accepted_range' AS check_name,
       (SELECT count(*) FROM orders WHERE NOT (o_totalprice >= 5000) OR NOT (o_totalprice <= 400000)) AS failures
UNION ALL SELECT 1, 'unique', (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1) u)
UNION ALL SELECT 2, 'not_null', (SELECT count(*) FROM orders WHERE o_orderkey IS NULL)
UNION ALL SELECT 3, 'fewer_rows_than', (SELECT CAST(sum(coalesce(CASE WHEN a > b THEN a - b WHEN a = b THEN 1 ELSE 0 END, 0)) AS BIGINT)
    FROM (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM orders) AS b) x)
""")
def q_dq_suite(spark, d):
    t = Tables(spark, d)
    checks = [Q.accepted_range(t.orders, "o_totalprice", 5000, 400000),
              Q.unique(t.orders, "o_custkey"),
              Q.not_null(t.orders, "o_orderkey"),
              Q.fewer_rows_than(t.lineitem, t.orders)]
    return Q.run_suite(checks).drop("status")


def _project_suite_sql():
    from .project_tests import oracle_sql
    return oracle_sql()


@query("dq_project_suite", _project_suite_sql())
def q_dq_project_suite(spark, d):
    from .layers import Warehouse
    from .project_tests import run_project_tests
    w = Warehouse(spark, d)
    # several checks and models read these; each is computed once, with what is checked
    w.keep("int_team_performance")
    w.keep("int_player_performance", columns=["game_id", "player_id"])
    w.keep("int_games_enriched", columns=["game_id", "home_team", "visitor_team"])
    return run_project_tests(w)
