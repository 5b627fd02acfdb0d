"""Queries exercising the DataFrame operators (P1-P4, A1-A6, T1, R1, G1-G4,
W1-W3, J1-J14) on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..fixed_values import UNION_SOURCE_COLUMN
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import select as S
from ..operators import series as G
from ..operators.dedupe import Order, deduplicate, first_per_key, latest_per_key
from ..sources.catalog import union_by_pattern
from ..sources.tables import Tables
from .layers import Warehouse
from .oracle_models import sk, with_models
from .registry import query


# ------------------------------------------------------------- P1-P4, A4
@query("star_except", "SELECT * EXCLUDE (p_name, p_brand) FROM part")
def q_star_except(spark, d):
    p = Tables(spark, d).part
    return p.select(*S.star(p, except_=["P_NAME", "p_brand"]))


@query("star_prefix_suffix", """
SELECT c_custkey AS cust_c_custkey_v, c_nationkey AS cust_c_nationkey_v,
       c_acctbal AS cust_c_acctbal_v, c_mktsegment AS cust_c_mktsegment_v
FROM customer
""")
def q_star_prefix_suffix(spark, d):
    c = Tables(spark, d).customer
    return c.select(*S.star(c, except_=["c_name"], prefix="cust_", suffix="_v"))


@query("star_aggregate", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS max_price
FROM orders GROUP BY o_orderstatus, o_orderpriority
""")
def q_star_aggregate(spark, d):
    o = Tables(spark, d).orders
    keys = S.star(o, except_=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    return o.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_orders"),
                                F.max("o_totalprice").alias("max_price"))


@query("filtered_columns_max", """
SELECT max(l_quantity) AS max_l_quantity, max(l_extendedprice) AS max_l_extendedprice,
       max(l_discount) AS max_l_discount, max(l_tax) AS max_l_tax
FROM lineitem
""")
def q_filtered_columns_max(spark, d):
    li = Tables(spark, d).lineitem
    cols = S.filtered_columns(li, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                   "l_returnflag", "l_linestatus", "l_shipdate"])
    return li.agg(*[F.max(c).alias(f"max_{c}") for c in cols])


@query("nullcheck_table", """
SELECT c_custkey, nullif(CASE WHEN c_custkey % 6 = 0 THEN '' ELSE c_name END, '') AS c_name,
       c_nationkey, nullif(CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END, '') AS c_mktsegment
FROM customer
""")
def q_nullcheck_table(spark, d):
    c = Tables(spark, d).customer
    k = F.col("c_custkey")
    t = c.select("c_custkey", F.when(k % 6 == 0, "").otherwise(F.col("c_name")).alias("c_name"),
                 "c_nationkey",
                 F.when(k % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return S.nullcheck_table(t)


@query("group_by_n", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders, CAST(sum(o_custkey) AS BIGINT) AS sum_custkey
FROM orders GROUP BY 1, 2
""")
def q_group_by_n(spark, d):
    o = Tables(spark, d).orders.select("o_orderstatus", "o_orderpriority", "o_custkey")
    return S.group_by_n(o, 2, F.count(F.lit(1)).alias("n_orders"),
                        F.sum("o_custkey").alias("sum_custkey"))


# ------------------------------------------------------------- A1, A2, A6
@query("agg_conditional_max", """
SELECT l_orderkey, max(CASE WHEN l_discount > 0.09 THEN 1 ELSE 0 END) AS has_big_discount
FROM lineitem GROUP BY 1
""")
def q_agg_conditional_max(spark, d):
    li = Tables(spark, d).lineitem
    return li.groupBy("l_orderkey").agg(A.any_match(F.col("l_discount") > 0.09).alias("has_big_discount"))


@query("distinct_members", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def q_distinct_members(spark, d):
    return A.distinct_members(Tables(spark, d).orders, ["o_orderstatus", "o_orderpriority"])


@query("column_values_topk", """
SELECT l_partkey, count(*) AS ordering FROM lineitem WHERE l_returnflag <> 'N'
GROUP BY l_partkey ORDER BY ordering DESC NULLS LAST, l_partkey ASC NULLS LAST LIMIT 10
""")
def q_column_values_topk(spark, d):
    li = Tables(spark, d).lineitem
    return A.column_values(li, "l_partkey", max_records=10, where=F.col("l_returnflag") != "N")


# -------------------------------------------------------------------- A5
def _pivot_count_sql():
    return """
SELECT o_orderstatus,
  CAST(count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS _1_urgent,
  CAST(count(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS _2_high,
  CAST(count(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) AS BIGINT) AS _3_medium,
  CAST(count(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END) AS BIGINT) AS _4_not_specified,
  CAST(count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS _5_low,
  CAST(count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS BIGINT) AS n_urgent
FROM orders GROUP BY o_orderstatus
"""


@query("pivot_count", _pivot_count_sql())
def q_pivot_count(spark, d):
    o = Tables(spark, d).orders
    # pivot values come from the data (A6 -> A5); the list is bounded and
    # sorted so the output schema is stable
    values = sorted(A.column_values_list(o, "o_orderpriority", max_records=100))
    cols = R.pivot_columns("o_orderpriority", values, agg="count", quote_identifiers=False)
    urgent = R.pivot_columns("o_orderpriority", ["1-URGENT"], agg="count", else_value=None,
                             prefix="n_", quote_identifiers=False)
    urgent = [urgent[0].alias("n_urgent")]
    return o.groupBy("o_orderstatus").agg(*cols, *urgent)


@query("pivot_sum_value", """
SELECT l_returnflag,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS "qty_O",
  CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS "qty_F"
FROM lineitem GROUP BY l_returnflag
""")
def q_pivot_sum_value(spark, d):
    li = Tables(spark, d).lineitem
    return R.pivot(li, ["l_returnflag"], "l_linestatus", ["O", "F"], agg="sum",
                   then_value=F.col("l_quantity").cast("bigint"), prefix="qty_")


@query("pivot_distinct", """
SELECT o_orderstatus,
  count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE 0 END) AS "1-URGENT_customers",
  count(DISTINCT CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey ELSE 0 END) AS "5-LOW_customers"
FROM orders GROUP BY o_orderstatus
""")
def q_pivot_distinct(spark, d):
    o = Tables(spark, d).orders
    return R.pivot(o, ["o_orderstatus"], "o_orderpriority", ["1-URGENT", "5-LOW"], agg="count",
                   distinct=True, then_value=F.col("o_custkey"), else_value=0,
                   suffix="_customers")


@query("pivot_cmp", """
SELECT l_returnflag,
  CAST(sum(CASE WHEN l_quantity >= 10 THEN 1 ELSE 0 END) AS BIGINT) AS qty_ge_10,
  CAST(sum(CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END) AS BIGINT) AS qty_ge_25,
  CAST(sum(CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END) AS BIGINT) AS qty_ge_40
FROM lineitem GROUP BY l_returnflag
""")
def q_pivot_cmp(spark, d):
    li = Tables(spark, d).lineitem
    return R.pivot(li, ["l_returnflag"], "l_quantity", [10, 25, 40], cmp=">=", prefix="qty_ge_")


# -------------------------------------------------------------------- R1
@query("unpivot", """
SELECT l_orderkey, l_linenumber, 'l_partkey' AS field_name, CAST(l_partkey AS BIGINT) AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_suppkey', CAST(l_suppkey AS BIGINT) FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_quantity', CAST(l_quantity AS BIGINT) FROM lineitem
""")
def q_unpivot(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          "l_quantity")
    return R.unpivot(li, cast_to="bigint", exclude=["l_orderkey", "l_linenumber"])


@query("unpivot_bool", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_discount > 0.05 AS is_discounted,
                  CASE WHEN l_partkey % 5 <> 0 THEN l_tax > 0.05 END AS is_taxed, l_returnflag FROM lineitem)
SELECT l_orderkey, l_linenumber, 'is_discounted' AS field_name, CAST(is_discounted AS VARCHAR) AS value FROM t
UNION ALL SELECT l_orderkey, l_linenumber, 'is_taxed', CAST(is_taxed AS VARCHAR) FROM t
UNION ALL SELECT l_orderkey, l_linenumber, 'l_returnflag', l_returnflag FROM t
""")
def q_unpivot_bool(spark, d):
    li = Tables(spark, d).lineitem
    t = li.select("l_orderkey", "l_linenumber", (F.col("l_discount") > 0.05).alias("is_discounted"),
                  F.when(F.col("l_partkey") % 5 != 0, F.col("l_tax") > 0.05).alias("is_taxed"),
                  "l_returnflag")
    return R.unpivot(t, cast_to="string", exclude=["l_orderkey", "l_linenumber"])


@query("unpivot_remove", """
SELECT o_orderkey, 'o_orderstatus' AS attribute, o_orderstatus AS attr_value FROM orders
UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders
""")
def q_unpivot_remove(spark, d):
    o = Tables(spark, d).orders
    return R.unpivot(o, cast_to="string", exclude=["o_orderkey"],
                     remove=["O_TOTALPRICE", "o_orderdate"], field_name="attribute",
                     value_name="attr_value")


# -------------------------------------------------------------------- T1
def _union_inputs(spark, d):
    t = Tables(spark, d)
    cust = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    supp = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                             F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return {"customer": cust, "supplier": supp}


_U_CUST = "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer"
_U_SUPP = "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier"


def _union_sql(cols_c, cols_s, where="", src=True):
    tag_c = f"'customer' AS {UNION_SOURCE_COLUMN}, " if src else ""
    tag_s = f"'supplier' AS {UNION_SOURCE_COLUMN}, " if src else ""
    w = f" WHERE {where}" if where else ""
    return (f"SELECT {tag_c}{cols_c} FROM ({_U_CUST}) c{w}\n"
            f"UNION ALL SELECT {tag_s}{cols_s} FROM ({_U_SUPP}) s{w}")


@query("union_relations", _union_sql(
    "id, name, nation, segment, CAST(NULL AS DOUBLE) AS balance",
    "id, name, nation, CAST(NULL AS VARCHAR) AS segment, balance"))
def q_union_relations(spark, d):
    return R.union_relations(_union_inputs(spark, d))


@query("union_include", _union_sql("id, name", "id, name"))
def q_union_include(spark, d):
    return R.union_relations(_union_inputs(spark, d), include=["ID", "name"])


@query("union_exclude", _union_sql("id, name, nation", "id, name, nation"))
def q_union_exclude(spark, d):
    return R.union_relations(_union_inputs(spark, d), exclude=["segment", "BALANCE"])


@query("union_where", _union_sql(
    "id, name, nation, segment, CAST(NULL AS DOUBLE) AS balance",
    "id, name, nation, CAST(NULL AS VARCHAR) AS segment, balance", where="nation < 10"))
def q_union_where(spark, d):
    return R.union_relations(_union_inputs(spark, d), where="nation < 10")


@query("union_no_source", _union_sql(
    "id, name, nation, segment, CAST(NULL AS DOUBLE) AS balance",
    "id, name, nation, CAST(NULL AS VARCHAR) AS segment, balance", src=False))
def q_union_no_source(spark, d):
    return R.union_relations(_union_inputs(spark, d), source_column_name=None)


@query("union_override", _union_sql(
    "id, name, CAST(nation AS BIGINT) AS nation, segment, CAST(NULL AS DOUBLE) AS balance",
    "id, name, CAST(nation AS BIGINT) AS nation, CAST(NULL AS VARCHAR) AS segment, balance"))
def q_union_override(spark, d):
    return R.union_relations(_union_inputs(spark, d), column_override={"nation": "bigint"})


@query("union_by_pattern", f"""
SELECT 'events_click' AS {UNION_SOURCE_COLUMN}, event_id, ts, user_id, value, CAST(NULL AS VARCHAR) AS props
  FROM events WHERE event_type = 'click'
UNION ALL SELECT 'events_other', event_id, ts, user_id, value, props
  FROM events WHERE event_type NOT IN ('click', 'purchase') OR event_type IS NULL
UNION ALL SELECT 'events_purchase', event_id, ts, user_id, value, props
  FROM events WHERE event_type = 'purchase'
""")
def q_union_by_pattern(spark, d):
    ev = Tables(spark, d).events
    typ = F.col("event_type")
    # dated/typed split tables registered in the session catalog, as a
    # warehouse would hold them; the operator finds them by name pattern
    ev.filter(typ == "click").select("event_id", "ts", "user_id", "value") \
        .createOrReplaceTempView("events_click")
    ev.filter(typ == "purchase").select("event_id", "ts", "user_id", "value", "props") \
        .createOrReplaceTempView("events_purchase")
    ev.filter(~typ.isin("click", "purchase") | typ.isNull()) \
        .select("event_id", "ts", "user_id", "value", "props").createOrReplaceTempView("events_other")
    return union_by_pattern(spark, table_pattern="events\\_%", exclude="events\\_archive%")


# ----------------------------------------------------------------- W1-W3
@query("latest_per_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST,
      event_id ASC NULLS FIRST, ts ASC NULLS FIRST, user_id ASC NULLS FIRST, event_type ASC NULLS FIRST,
      value ASC NULLS FIRST, props ASC NULLS FIRST) AS rn
  FROM events) x WHERE rn = 1
""")
def q_latest_per_key(spark, d):
    return latest_per_key(Tables(spark, d).events, "user_id", "ts")


@query("first_per_key", """
SELECT doc_id, lang, source, n_chars FROM (
  SELECT doc_id, lang, source, n_chars, row_number() OVER (PARTITION BY lang, source ORDER BY
      n_chars ASC NULLS LAST, doc_id ASC NULLS FIRST, lang ASC NULLS FIRST, source ASC NULLS FIRST,
      n_chars ASC NULLS FIRST) AS rn
  FROM documents) x WHERE rn = 1
""")
def q_first_per_key(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "lang", "source", "n_chars")
    return first_per_key(docs, ["lang", "source"], "n_chars")


@query("deduplicate", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
      l_shipdate DESC NULLS FIRST, l_partkey ASC NULLS LAST,
      l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
      l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM lineitem) x WHERE rn = 1
""")
def q_deduplicate(spark, d):
    li = Tables(spark, d).lineitem
    return deduplicate(li, ["l_orderkey", "l_linenumber"],
                       [Order("l_shipdate", desc=True), Order("l_partkey")])


# ----------------------------------------------------------------- G1-G4
@query("date_spine_day", """
SELECT CAST(d AS DATE) AS date_day FROM
  (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders) b,
  generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP) - INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)
""")
def q_date_spine_day(spark, d):
    o = Tables(spark, d).orders
    b = o.agg(F.min(F.col("o_orderdate").cast("date")).alias("lo"),
              F.max(F.col("o_orderdate").cast("date")).alias("hi"))
    return G.date_spine(b, "lo", "hi", "day")


@query("date_spine_month", """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) + 17 AS lo, max(CAST(l_shipdate AS DATE)) AS hi
           FROM orders, (SELECT max(l_shipdate) AS l_shipdate FROM lineitem) m)
SELECT CAST(lo + to_months(CAST(i AS INTEGER)) AS DATE) AS date_month
FROM b, range(0, datediff('month', lo, hi)) t(i)
WHERE CAST(lo + to_months(CAST(i AS INTEGER)) AS DATE) <= hi
""")
def q_date_spine_month(spark, d):
    t = Tables(spark, d)
    lo = t.orders.agg(F.date_add(F.min(F.col("o_orderdate").cast("date")), 17).alias("lo"))
    hi = t.lineitem.agg(F.max(F.col("l_shipdate").cast("date")).alias("hi"))
    # two one-row aggregates of different tables into one row
    bounds = (lo.withColumn("hi", F.lit(None).cast("date"))
              .unionByName(hi.withColumn("lo", F.lit(None).cast("date")))
              .agg(F.max("lo").alias("lo"), F.max("hi").alias("hi")))
    return G.date_spine(bounds, "lo", "hi", "month")


@query("intervals_between", """
SELECT o_orderkey,
  CAST(datediff('day', CAST(o_orderdate AS DATE), DATE '2002-03-15') AS INTEGER) AS days,
  CAST(floor(datediff('day', CAST(o_orderdate AS DATE), DATE '2002-03-15') / 7) AS INTEGER) AS weeks,
  CAST(datediff('month', CAST(o_orderdate AS DATE), DATE '2002-03-15') AS INTEGER) AS months,
  CAST(datediff('quarter', CAST(o_orderdate AS DATE), DATE '2002-03-15') AS INTEGER) AS quarters,
  CAST(datediff('year', CAST(o_orderdate AS DATE), DATE '2002-03-15') AS INTEGER) AS years
FROM orders
""")
def q_intervals_between(spark, d):
    o = Tables(spark, d).orders
    s, e = F.col("o_orderdate").cast("date"), F.lit("2002-03-15").cast("date")
    return o.select("o_orderkey", *[G.intervals_between(s, e, p).alias(n) for p, n in
                                    [("day", "days"), ("week", "weeks"), ("month", "months"),
                                     ("quarter", "quarters"), ("year", "years")]])


@query("generate_series", """
SELECT generate_series AS generated_number FROM generate_series(1, (SELECT max(l_linenumber) FROM lineitem))
""")
def q_generate_series(spark, d):
    li = Tables(spark, d).lineitem
    return G.generate_series(li.agg(F.max("l_linenumber").alias("n")), "n")


@query("scalar_value_default", """
SELECT (SELECT min(CAST(o_orderdate AS DATE)) FROM orders) AS first_order_date,
       coalesce((SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'none'), -1) AS missing_default
""")
def q_scalar_value_default(spark, d):
    o = Tables(spark, d).orders
    first = G.single_value(o.agg(F.min(F.col("o_orderdate").cast("date"))))
    missing = G.single_value(o.filter(F.col("o_orderstatus") == "none").select("o_orderkey"), default=-1)
    both = (first.select(F.col("value").alias("first_order_date"),
                         F.lit(None).cast("bigint").alias("missing_default"))
            .unionByName(missing.select(F.lit(None).cast("date").alias("first_order_date"),
                                        F.col("value").cast("bigint").alias("missing_default"))))
    return both.agg(F.max("first_order_date").alias("first_order_date"),
                    F.max("missing_default").alias("missing_default"))


# ----------------------------------------------------------------- joins
@query("join_conform", """
SELECT c_custkey, n.n_name AS nation_name
FROM customer c LEFT JOIN nation n
  ON (CASE WHEN c.c_custkey % 10 = 0 THEN c.c_nationkey + 100 ELSE c.c_nationkey END) = n.n_nationkey
""")
def q_join_conform(spark, d):
    t = Tables(spark, d)
    c = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 10 == 0, F.col("c_nationkey") + 100)
                          .otherwise(F.col("c_nationkey")).alias("nk"))
    return J.conform(c, t.nation, "nk", "n_nationkey", "n_name", "nation_name").select("c_custkey", "nation_name")


@query("join_multi_key", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, d.n_lines
FROM lineitem l LEFT JOIN (SELECT l_orderkey, l_linenumber, count(*) AS n_lines FROM lineitem
                           WHERE l_returnflag <> 'R' GROUP BY 1, 2) d
  ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber
""")
def q_join_multi_key(spark, d):
    """The filter on the counted side makes the keys that the left join does not match."""
    li = Tables(spark, d).lineitem
    counts = (li.filter(F.col("l_returnflag") != "R").groupBy("l_orderkey", "l_linenumber")
              .agg(F.count(F.lit(1)).alias("n_lines")))
    return (li.select("l_orderkey", "l_linenumber", "l_partkey")
            .join(counts, ["l_orderkey", "l_linenumber"], "left"))


@query("join_role_playing", """
SELECT o.o_orderkey, cn.n_name AS customer_nation, sn.n_name AS ship_nation
FROM orders o
LEFT JOIN nation cn ON cn.n_nationkey = o.o_custkey % 25
LEFT JOIN nation sn ON sn.n_nationkey = (o.o_custkey + o.o_orderkey) % 31
""")
def q_join_role_playing(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey", (F.col("o_custkey") % 25).alias("cn"),
                        ((F.col("o_custkey") + F.col("o_orderkey")) % 31).alias("sn"))
    o = J.lookup(o, t.nation, [("cn", "n_nationkey")], [("n_name", "customer_nation")])
    o = J.lookup(o, t.nation, [("sn", "n_nationkey")], [("n_name", "ship_nation")])
    return o.select("o_orderkey", "customer_nation", "ship_nation")


@query("join_on_expr", """
SELECT l.l_orderkey, l.l_linenumber, o.o_orderpriority
FROM lineitem l LEFT JOIN orders o
  ON CAST(l.l_shipdate AS DATE) = CAST(o.o_orderdate AS DATE) + 30 AND l.l_orderkey = o.o_orderkey
""")
def q_join_on_expr(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    o = t.orders.select("o_orderkey", F.date_add(F.col("o_orderdate").cast("date"), 30).alias("due"),
                        "o_orderpriority")
    out = J.lookup(li, o, [(F.col("l_shipdate").cast("date"), "due"), ("l_orderkey", "o_orderkey")],
                   [("o_orderpriority", "o_orderpriority")])
    return out.select("l_orderkey", "l_linenumber", "o_orderpriority")


@query("semi_join", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def q_semi_join(spark, d):
    t = Tables(spark, d)
    keys = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return J.semi(t.orders.select("o_orderkey", "o_custkey"), keys, ["o_custkey"])


@query("natural_join", """
SELECT * FROM
  (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_nationkey END AS c_nationkey, c_name FROM customer) a
NATURAL JOIN (SELECT c_custkey, c_nationkey, c_mktsegment FROM customer) b
""")
def q_natural_join(spark, d):
    c = Tables(spark, d).customer
    a = c.select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_nationkey")).alias("c_nationkey"),
                 "c_name")
    b = c.select("c_custkey", "c_nationkey", "c_mktsegment")
    return J.natural_join(a, b)


@query("self_join_opponent", with_models("""
SELECT a.game_id, a.team, a.total_points, b.team AS opponent_team, b.total_points AS opponent_points
FROM stg_line_scores a JOIN stg_line_scores b ON a.game_id = b.game_id AND a.team <> b.team
"""))
def q_self_join_opponent(spark, d):
    ls = Warehouse(spark, d).stg_line_scores.select("game_id", "team", "total_points")
    out = J.other_side(ls, ["game_id"], "team", ["total_points"], prefix="opp_")
    return out.select("game_id", "team", "total_points", F.col("opp_team").alias("opponent_team"),
                      F.col("opp_total_points").alias("opponent_points"))


@query("join_junk_dim", with_models("""
SELECT pp.game_id, pp.player_id, arch.archetype_key
FROM int_player_performance pp LEFT JOIN dim_player_game_archetypes arch
  ON pp.usage_tier = arch.usage_tier AND pp.impact_tier = arch.impact_tier
 AND pp.shooting_efficiency_tier = arch.shooting_efficiency_tier AND pp.minutes_based_role = arch.minutes_based_role
 AND pp.is_double_double = arch.is_double_double AND pp.is_triple_double = arch.is_triple_double
 AND pp.is_versatile = arch.is_versatile AND pp.is_defensive_specialist = arch.is_defensive_specialist
 AND pp.is_three_and_d = arch.is_three_and_d
"""))
def q_join_junk_dim(spark, d):
    from .models.dimensions import ARCHETYPE_COLS
    # the dimension is made of the rows that are looked up: they are computed once
    w = Warehouse(spark, d).keep("int_player_performance", columns=["game_id", "player_id", *ARCHETYPE_COLS])
    out = J.lookup(w.int_player_performance, w.dim_player_game_archetypes,
                   [(c, c) for c in ARCHETYPE_COLS], [("archetype_key", "archetype_key")])
    return out.select("game_id", "player_id", "archetype_key")


@query("star_lookup", f"""
WITH days AS (
  SELECT CAST(dd AS DATE) AS full_date FROM
    (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders) b,
    generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) t(dd)),
dim_date AS (SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date FROM days),
dim_customer AS (SELECT {sk('c_custkey')} AS customer_key, c_custkey FROM customer)
SELECT {sk('o.o_orderkey')} AS order_key, d.date_key, c.customer_key, o.o_orderkey, o.o_totalprice
FROM orders o
LEFT JOIN dim_date d ON CAST(o.o_orderdate AS DATE) = d.full_date
LEFT JOIN dim_customer c ON o.o_custkey = c.c_custkey
""")
def q_star_lookup(spark, d):
    t = Tables(spark, d)
    o = t.orders
    bounds = o.agg(F.min(F.col("o_orderdate").cast("date")).alias("lo"),
                   F.max(F.col("o_orderdate").cast("date")).alias("hi"))
    dim_date = (G.day_series_inclusive(bounds, "lo", "hi", "full_date")
                .select(X.date_key("full_date").alias("date_key"), "full_date"))
    dim_customer = t.customer.select(X.surrogate_key("c_custkey").alias("customer_key"), "c_custkey")
    f = J.lookup(o, dim_date, [(F.col("o_orderdate").cast("date"), "full_date")],
                 [("date_key", "date_key")])  # calendar days: bounded
    f = J.lookup(f, dim_customer, [("o_custkey", "c_custkey")], [("customer_key", "customer_key")])
    return f.select(X.surrogate_key("o_orderkey").alias("order_key"), "date_key", "customer_key",
                    "o_orderkey", "o_totalprice")


@query("scalar_subquery_lookback", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - INTERVAL 30 DAY
""")
def q_scalar_subquery_lookback(spark, d):
    from .models.facts import _since_filter, lookback_since
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return _since_filter(o, lookback_since(o, 30, "o_orderdate"), "o_orderdate")
