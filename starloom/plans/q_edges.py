"""Registered queries for inputs that the plain ones do not reach: fractional
buckets, NULL scalars, mixed-case names, text-ordered ranges, long decimals."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import functions as X
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import reshape as R
from ..operators import series as G
from ..session import ensure_checkpoint_dir
from ..sources.sinks import read_layer, store_failures, write_layer
from ..sources.tables import Tables, read_seed_csv, scan_live
from .registry import query


@query("width_bucket_fractional", """
WITH t AS (SELECT l_orderkey, l_linenumber, CAST(CAST(l_partkey % 1000 AS DOUBLE) / 1000 AS DECIMAL(18, 6)) AS x FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE WHEN x % CAST(0.1 AS DECIMAL(18, 6)) = 0 THEN 1 ELSE 0 END + least(CAST(ceil(x * 10) AS BIGINT), 11) AS bucket
FROM t""")
def q_width_bucket_fractional(spark, d):
    li = Tables(spark, d).lineitem
    x = (F.col("l_partkey") % 1000).cast("double") / 1000
    return li.select("l_orderkey", "l_linenumber", X.width_bucket(x, 0.0, 1.0, 10).cast("bigint").alias("bucket"))


@query("pivot_avg_distinct", """
SELECT l_returnflag, avg(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_linenumber END) AS "O",
       avg(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_linenumber END) AS "F"
FROM lineitem GROUP BY l_returnflag""")
def q_pivot_avg_distinct(spark, d):
    return R.pivot(Tables(spark, d).lineitem, ["l_returnflag"], "l_linestatus", ["O", "F"], agg="avg", distinct=True,
                   then_value=F.col("l_linenumber"), else_value=None)


@query("single_value_null", "SELECT max(CASE WHEN o_totalprice < 0 THEN o_orderkey END) AS value FROM orders")
def q_single_value_null(spark, d):
    none = Tables(spark, d).orders.agg(F.max(F.when(F.col("o_totalprice") < 0, F.col("o_orderkey"))).alias("v"))
    return G.single_value(none, default=-1)


@query("union_mixed_case", """
SELECT 'customer' AS src, c_custkey AS "ID", c_name AS "Name" FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier""")
def q_union_mixed_case(spark, d):
    t = Tables(spark, d)
    return R.union_relations([("customer", t.customer.select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("Name"))),
                              ("supplier", t.supplier.select(F.col("s_name").alias("NAME"), F.col("s_suppkey").alias("id")))],
                             source_column_name="src")


@query("scan_soft_delete", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P' AND o_custkey IS NOT NULL""")
def q_scan_soft_delete(spark, d):
    rows = Tables(spark, d).orders.withColumn("deleted_at", F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")))
    return scan_live(rows, required=["o_custkey"]).select("o_orderkey", "o_custkey")


@query("star_lookup_one_row", """
SELECT c_custkey, s.name AS supplier_name
FROM customer LEFT JOIN (SELECT s_nationkey, min(s_name) AS name FROM supplier GROUP BY s_nationkey) s ON s_nationkey = c_nationkey""")
def q_star_lookup_one_row(spark, d):
    t = Tables(spark, d)
    return J.lookup(t.customer.select("c_custkey", "c_nationkey"), t.supplier, [("c_nationkey", "s_nationkey")],
                    [("s_name", "supplier_name")], one_row_per_key=True).select("c_custkey", "supplier_name")


@query("dq_mutually_exclusive_ranges_text", """
WITH t AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS lower_bound,
                  lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || CASE WHEN o_orderstatus = 'F' THEN '~' ELSE 'a' END AS upper_bound,
                  o_orderstatus FROM orders),
u AS (SELECT lower_bound, CASE WHEN o_orderstatus = 'P' THEN '~' ELSE upper_bound END AS upper_bound FROM t),
w AS (SELECT lower_bound, upper_bound, lead(lower_bound) OVER (ORDER BY lower_bound, upper_bound) AS next_lower_bound,
             row_number() OVER (ORDER BY lower_bound DESC, upper_bound DESC) = 1 AS is_last_record FROM u),
c AS (SELECT *, coalesce(lower_bound < upper_bound, false) AS lower_bound_less_than_upper_bound,
             coalesce(upper_bound <= next_lower_bound, is_last_record, false) AS upper_bound_less_than_or_equal_to_next_lower_bound FROM w)
SELECT * FROM c WHERE NOT (lower_bound_less_than_upper_bound AND upper_bound_less_than_or_equal_to_next_lower_bound)""")
def q_dq_mutually_exclusive_ranges_text(spark, d):
    lo = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    hi = F.when(F.col("o_orderstatus") == "P", "~").otherwise(
        F.concat(lo, F.when(F.col("o_orderstatus") == "F", "~").otherwise("a")))
    return Q.mutually_exclusive_ranges(Tables(spark, d).orders.select(lo.alias("lo"), hi.alias("hi")), "lo", "hi").failures


@query("dq_equality_precision_12", """
WITH a AS (SELECT c_custkey, round(CAST(c_custkey AS DECIMAL(20, 0)) + CAST(0.12345678901249 AS DECIMAL(30, 14)), 12) AS v FROM customer),
b AS (SELECT c_custkey, round(CAST(c_custkey AS DECIMAL(20, 0)) + CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(0.12345678903449 AS DECIMAL(30, 14))
        ELSE CAST(0.12345678901240 AS DECIMAL(30, 14)) END, 12) AS v FROM customer)
SELECT 'a_minus_b' AS which_diff, c_custkey, CAST(v AS VARCHAR) AS v FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', c_custkey, CAST(v AS VARCHAR) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def q_dq_equality_precision_12(spark, d):
    c = Tables(spark, d).customer
    key = F.col("c_custkey").cast("decimal(20,0)")

    def side(extra):
        return c.select("c_custkey", (key + extra).cast("decimal(36,14)").alias("v"))

    part = [F.lit(x).cast("decimal(15,14)") for x in ("0.12345678901249", "0.12345678903449", "0.12345678901240")]
    diff = Q.equality(side(part[0]), side(F.when(F.col("c_mktsegment") == "BUILDING", part[1]).otherwise(part[2])),
                      precision=12).failures
    return diff.withColumn("v", F.col("v").cast("string"))


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("table_sink", "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date FROM orders")
def q_table_sink(spark, d):
    """Full-refresh sink (S4), partitioned and clustered, written twice and read back."""
    rows = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("order_date"))
    path = _scratch(spark, "table")
    for _ in range(2):
        write_layer(rows, path, partition_by=["o_orderstatus"], sort_within=["order_date"])
    return read_layer(spark, path).select("o_orderkey", "o_orderstatus", "order_date")


@query("view_sink", "SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey")
def q_view_sink(spark, d):
    """A model as a session view (S3), read by SQL."""
    Tables(spark, d).customer.createOrReplaceTempView("starloom_customers")
    return spark.sql("SELECT c_nationkey, count(*) AS customers FROM starloom_customers GROUP BY c_nationkey")


@query("seed_csv", "SELECT n_nationkey, n_name FROM nation")
def q_seed_csv(spark, d):
    """Seed load (S2): a CSV with its columns in another order."""
    path = _scratch(spark, "seed")
    Tables(spark, d).nation.select("n_name", "n_nationkey").write.csv(path, header=True)
    return read_seed_csv(spark, path, f"n_nationkey {Tables(spark, d).nation.schema['n_nationkey'].dataType.simpleString()}, n_name string")


@query("failure_sink", """
SELECT 'accepted_range' AS check_name, count(*) AS failures FROM orders WHERE o_totalprice < 5000
UNION ALL SELECT 'unique', count(*) FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1)""")
def q_failure_sink(spark, d):
    """Failing rows stored (S6), then counted from the stored rows."""
    o = Tables(spark, d).orders
    stored = store_failures([Q.accepted_range(o, "o_totalprice", 5000), Q.unique(o, "o_custkey")], _scratch(spark, "failures"))
    return Q.run_suite(stored).select("check_name", "failures")
