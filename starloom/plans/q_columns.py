"""Queries exercising the column functions (F1-F22, P6-P11) on the test tables.

NULLs are introduced with ``CASE WHEN key % n = 0`` because the source
tables have none; the oracle SQL spells the same CASE.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..fixed_values import SURROGATE_KEY_NULL
from ..sources.tables import Tables
from .registry import query


def _null_when(col, key, n):
    return F.when(F.col(key) % n != 0, F.col(col))


# ---------------------------------------------------------------- F1 keys
@query("surrogate_key", f"""
SELECT c_custkey,
       md5(concat_ws('-',
           coalesce(CAST(c_custkey AS VARCHAR), '{SURROGATE_KEY_NULL}'),
           coalesce(CAST(CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS VARCHAR), '{SURROGATE_KEY_NULL}'),
           coalesce(CAST(c_nationkey AS VARCHAR), '{SURROGATE_KEY_NULL}'),
           coalesce(CAST(c_mktsegment = 'BUILDING' AS VARCHAR), '{SURROGATE_KEY_NULL}'))) AS customer_key
FROM customer
""")
def q_surrogate_key(spark, d):
    c = Tables(spark, d).customer
    return c.select("c_custkey", X.surrogate_key(
        "c_custkey", _null_when("c_name", "c_custkey", 7), "c_nationkey",
        F.col("c_mktsegment") == "BUILDING").alias("customer_key"))


@query("surrogate_key_nulls_empty", """
SELECT o_orderkey,
       md5(concat_ws('-',
           coalesce(CAST(o_orderkey AS VARCHAR), ''),
           coalesce(CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS VARCHAR), ''),
           coalesce(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), ''))) AS order_key
FROM orders
""")
def q_surrogate_key_nulls_empty(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", X.surrogate_key(
        "o_orderkey", _null_when("o_orderstatus", "o_orderkey", 5),
        F.col("o_orderdate").cast("date"), nulls_as_empty=True).alias("order_key"))


# ------------------------------------------------------- F2-F4 safe maths
@query("safe_add", """
SELECT l_orderkey, l_linenumber, l_partkey,
       coalesce(l_linenumber, 0)
       + coalesce(CASE WHEN l_partkey % 3 <> 0 THEN CAST(l_quantity AS BIGINT) END, 0)
       + coalesce(CASE WHEN l_partkey % 4 <> 0 THEN l_suppkey END, 0) AS total
FROM lineitem
""")
def q_safe_add(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber", "l_partkey", X.safe_add(
        "l_linenumber",
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_quantity").cast("bigint")),
        _null_when("l_suppkey", "l_partkey", 4)).alias("total"))


@query("safe_subtract", """
SELECT l_orderkey, l_linenumber, l_partkey,
       coalesce(CASE WHEN l_partkey % 3 <> 0 THEN CAST(l_quantity AS BIGINT) END, 0)
       - coalesce(l_linenumber, 0)
       - coalesce(CASE WHEN l_partkey % 4 <> 0 THEN l_suppkey END, 0) AS diff
FROM lineitem
""")
def q_safe_subtract(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber", "l_partkey", X.safe_subtract([
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_quantity").cast("bigint")),
        "l_linenumber", _null_when("l_suppkey", "l_partkey", 4)]).alias("diff"))


@query("safe_divide", """
SELECT o_orderkey,
       CAST(o_orderkey % 100 AS DOUBLE) / nullif(o_custkey % 4, 0) AS ratio,
       CAST(o_orderkey AS DOUBLE) / nullif((o_custkey % 3) * (o_orderkey % 2), 0) AS ratio_product
FROM orders
""")
def q_safe_divide(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey",
                    X.safe_divide((F.col("o_orderkey") % 100).cast("double"),
                                  F.col("o_custkey") % 4).alias("ratio"),
                    X.safe_divide(F.col("o_orderkey").cast("double"),
                                  (F.col("o_custkey") % 3) * (F.col("o_orderkey") % 2))
                    .alias("ratio_product"))


# --------------------------------------------------------- F6 width_bucket
@query("width_bucket", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
       CAST((CASE WHEN l_quantity % ((50.0 - 0.0) / 8) = 0 THEN 1 ELSE 0 END)
            + least(ceil((l_quantity - 0.0) / ((50.0 - 0.0) / 8)), 9) AS BIGINT) AS bucket
FROM lineitem
""")
def q_width_bucket(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                     X.width_bucket("l_quantity", 0.0, 50.0, 8).cast("bigint").alias("bucket"))


# ------------------------------------------------------------ F5 haversine
_HAV_SQL = """
SELECT c_custkey,
       round(2 * 3961 * asin(sqrt(
           pow(sin(radians(((c_nationkey * 7 - 80) - (c_custkey % 180 - 90)) / 2)), 2)
           + cos(radians(c_custkey % 180 - 90)) * cos(radians(c_nationkey * 7 - 80))
           * pow(sin(radians(((c_nationkey * 14 - 170) - ((c_custkey * 7) % 360 - 180)) / 2)), 2)
       )){factor}, 6) AS distance
FROM customer
"""


def _hav(spark, d, unit):
    c = Tables(spark, d).customer
    lat1 = F.col("c_custkey") % 180 - 90
    lon1 = (F.col("c_custkey") * 7) % 360 - 180
    lat2 = F.col("c_nationkey") * 7 - 80
    lon2 = F.col("c_nationkey") * 14 - 170
    return c.select("c_custkey",
                    F.round(X.haversine_distance(lat1, lon1, lat2, lon2, unit=unit), 6)
                    .alias("distance"))


@query("haversine_mi", _HAV_SQL.format(factor=""))
def q_haversine_mi(spark, d):
    return _hav(spark, d, "mi")


@query("haversine_km", _HAV_SQL.format(factor=" * 1.60934"))
def q_haversine_km(spark, d):
    return _hav(spark, d, "km")


# ------------------------------------------------------------- F7-F9 urls
_STRIP = "replace(replace(url, 'http://', ''), 'https://', '')"


@query("url_host", """
SELECT page_id, url,
       split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''),
                                     'https://', ''), '/', 1), '?', 1) AS host
FROM pages
""")
def q_url_host(spark, d):
    p = Tables(spark, d).pages
    return p.select("page_id", "url", X.url_host("url").alias("host"))


@query("url_path", f"""
SELECT page_id, url, CASE WHEN contains(s, '/') THEN regexp_extract(s, '^[^/]*/([^?]*)', 1)
                          WHEN contains(s, '?') THEN '' ELSE s END AS path
FROM (SELECT page_id, url, {_STRIP} AS s FROM pages)
""")
def q_url_path(spark, d):
    p = Tables(spark, d).pages
    return p.select("page_id", "url", X.url_path("url").alias("path"))


@query("url_parameter", """
SELECT page_id, url,
       nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref,
       nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page_param
FROM pages
""")
def q_url_parameter(spark, d):
    p = Tables(spark, d).pages
    return p.select("page_id", "url", X.url_parameter("url", "ref").alias("ref"),
                    X.url_parameter("url", "page").alias("page_param"))


# ------------------------------------------------------------- F10 slugify
@query("slugify_column", """
SELECT p_partkey,
       coalesce(regexp_replace(
           regexp_replace(regexp_replace(lower(CASE WHEN p_partkey % 9 <> 0 THEN
               CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size AS VARCHAR) || ' ' || p_type ELSE p_type || '-' || p_brand END END),
               '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1'), '') AS slug
FROM part
""")
def q_slugify_column(spark, d):
    p = Tables(spark, d).part
    raw = F.when(F.col("p_partkey") % 9 != 0,
                 F.when(F.col("p_partkey") % 4 == 0,
                        F.concat(F.col("p_size").cast("string"), F.lit(" "), F.col("p_type")))
                 .otherwise(F.concat(F.col("p_type"), F.lit("-"), F.col("p_brand"))))
    return p.select("p_partkey", X.slugify_col(raw).alias("slug"))


# ------------------------------------------------- F11 clock text, P10 cast
def _mp_sql(junk: bool) -> str:
    dnp = "WHEN l_partkey % 23 = 0 THEN 'DNP'" if junk else ""
    return f"""CASE WHEN l_partkey % 17 = 0 THEN NULL
            WHEN l_partkey % 19 = 0 THEN ''
            {dnp}
            WHEN l_partkey % 9 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
            ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ':' || lpad(CAST((l_partkey * 13) % 60 AS VARCHAR), 2, '0') END"""


def _mp_col(junk: bool):
    """Minutes text: 'MM:SS', plain numbers, NULL, '' and (with ``junk``)
    non-numeric text, which only the guarded form may read."""
    q = F.col("l_quantity").cast("bigint").cast("string")
    e = (F.when(F.col("l_partkey") % 17 == 0, F.lit(None).cast("string"))
         .when(F.col("l_partkey") % 19 == 0, F.lit("")))
    if junk:
        e = e.when(F.col("l_partkey") % 23 == 0, F.lit("DNP"))
    return (e.when(F.col("l_partkey") % 9 == 0, q)
            .otherwise(F.concat(q, F.lit(":"),
                                F.lpad(((F.col("l_partkey") * 13) % 60).cast("string"), 2, "0"))))


@query("clock_to_minutes", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {_mp_sql(False)} AS mp FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, mp,
       CASE WHEN mp IS NOT NULL AND mp <> '' AND mp LIKE '%:%'
            THEN CAST(split_part(mp, ':', 1) AS DOUBLE) + CAST(split_part(mp, ':', 2) AS DOUBLE) / 60.0
            WHEN mp IS NOT NULL AND mp <> '' THEN CAST(mp AS DOUBLE)
            ELSE 0.0 END AS minutes,
       CAST(CASE WHEN mp IS NOT NULL AND mp <> '' AND mp LIKE '%:%'
            THEN CAST(split_part(mp, ':', 1) AS DOUBLE) + CAST(split_part(mp, ':', 2) AS DOUBLE) / 60.0
            WHEN mp IS NOT NULL AND mp <> '' THEN CAST(mp AS DOUBLE)
            ELSE 0.0 END AS DECIMAL(10, 2)) AS minutes_2dp
FROM t
""")
def q_clock_to_minutes(spark, d):
    li = Tables(spark, d).lineitem
    t = li.select("l_orderkey", "l_linenumber", "l_partkey", _mp_col(False).alias("mp"))
    m = X.clock_to_minutes("mp")
    return t.select("*", m.alias("minutes"), m.cast("decimal(10,2)").alias("minutes_2dp"))


@query("regex_guarded_cast", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {_mp_sql(True)} AS mp FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, mp,
       CASE WHEN regexp_matches(mp, '^[0-9.]+$') THEN coalesce(TRY_CAST(mp AS DOUBLE), 0.0) ELSE 0.0 END AS mp_value,
       CASE WHEN mp IS NOT NULL AND mp <> '' AND mp LIKE '%:%'
            THEN CAST(split_part(mp, ':', 1) AS DOUBLE) + CAST(split_part(mp, ':', 2) AS DOUBLE) / 60.0
            WHEN mp IS NOT NULL AND mp <> '' THEN
                 CASE WHEN regexp_matches(mp, '^[0-9.]+$') THEN coalesce(TRY_CAST(mp AS DOUBLE), 0.0) ELSE 0.0 END
            ELSE 0.0 END AS minutes
FROM t
""")
def q_regex_guarded_cast(spark, d):
    li = Tables(spark, d).lineitem
    t = li.select("l_orderkey", "l_linenumber", "l_partkey", _mp_col(True).alias("mp"))
    return t.select("*", X.regex_guarded_cast("mp").alias("mp_value"),
                    X.clock_to_minutes("mp", guarded=True).alias("minutes"))


# -------------------------------------------------------- F15/F16 seasons
@query("season_start", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS game_date,
       CAST(CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER) AS season_start_year,
       CAST(CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS VARCHAR)
         || '-' || substr(CAST(CAST(CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER) + 1 AS VARCHAR), 3, 2) AS season_display
FROM orders
""")
def q_season_start(spark, d):
    o = Tables(spark, d).orders
    s = X.season_start_year("o_orderdate")
    return o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("game_date"),
                    s.alias("season_start_year"), X.season_label(s).alias("season_display"))


# ------------------------------------------------------ P6/P7/P8 tiering
@query("tiering", """
SELECT o_orderkey,
       CASE WHEN o_totalprice >= 400000 THEN 'Elite'
            WHEN o_totalprice >= 250000 THEN 'Good'
            WHEN o_totalprice >= 100000 THEN 'Average'
            ELSE 'Below Average' END AS price_tier,
       CASE WHEN o_orderkey % 10 = 0 THEN 'Insufficient'
            WHEN o_totalprice <= 50000 THEN 'Low'
            WHEN o_totalprice <= 150000 THEN 'Mid'
            ELSE 'High' END AS guarded_tier
FROM orders
""")
def q_tiering(spark, d):
    o = Tables(spark, d).orders
    return o.select(
        "o_orderkey",
        X.tier("o_totalprice", [(400000, "Elite"), (250000, "Good"), (100000, "Average")],
               "Below Average").alias("price_tier"),
        X.tier("o_totalprice", [(50000, "Low"), (150000, "Mid")], "High", op="<=",
               guards=[(F.col("o_orderkey") % 10 == 0, "Insufficient")]).alias("guarded_tier"))


@query("quartile_labels", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_quantity < 5 THEN 'Insufficient'
            WHEN l_quantity < 16.18 THEN 'Q1'
            WHEN l_quantity < 24.38 THEN 'Q2'
            WHEN l_quantity < 32.18 THEN 'Q3'
            ELSE 'Q4' END AS quantity_quartile
FROM lineitem
""")
def q_quartile_labels(spark, d):
    li = Tables(spark, d).lineitem
    from .models.staging import MINUTES
    return li.select("l_orderkey", "l_linenumber", "l_partkey", X.tier(
        "l_quantity", [(MINUTES.q1_val, "Q1"), (MINUTES.median_val, "Q2"), (MINUTES.q3_val, "Q3")],
        "Q4", op="<", guards=[(F.col("l_quantity") < MINUTES.insufficient, "Insufficient")])
        .alias("quantity_quartile"))


@query("composite_flags", """
SELECT l_orderkey, l_linenumber, l_partkey,
       (l_quantity >= 16 AND (l_discount >= 0.05 OR l_tax >= 0.04) AND l_extendedprice < 50000) AS is_flagged,
       (l_quantity >= 16 AND l_quantity < 32) AS is_mid_quantity
FROM lineitem
""")
def q_composite_flags(spark, d):
    li = Tables(spark, d).lineitem
    q = F.col("l_quantity")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     ((q >= 16) & ((F.col("l_discount") >= 0.05) | (F.col("l_tax") >= 0.04))
                      & (F.col("l_extendedprice") < 50000)).alias("is_flagged"),
                     ((q >= 16) & (q < 32)).alias("is_mid_quantity"))


# ------------------------------------------------------ P9 LIKE classes
@query("like_any_class", """
WITH t AS (SELECT o_orderkey, CAST(1 + o_orderkey % 12 AS VARCHAR) || ':30' ||
                  CASE WHEN o_orderkey % 5 = 0 THEN 'a' ELSE 'p' END AS start_time
           FROM orders)
SELECT o_orderkey, start_time,
       CASE WHEN start_time LIKE '%12:%p%' THEN 'Afternoon'
            WHEN start_time LIKE '%1:%p%' OR start_time LIKE '%2:%p%' OR start_time LIKE '%3:%p%' THEN 'Afternoon'
            WHEN start_time LIKE '%7:%p%' OR start_time LIKE '%8:%p%' THEN 'Prime Time'
            ELSE 'Late Night' END AS time_slot
FROM t
""")
def q_like_any_class(spark, d):
    o = Tables(spark, d).orders
    t = o.select("o_orderkey", F.concat((1 + F.col("o_orderkey") % 12).cast("string"), F.lit(":30"),
                                        F.when(F.col("o_orderkey") % 5 == 0, "a").otherwise("p"))
                 .alias("start_time"))
    from .models.staging import time_slot
    return t.select("o_orderkey", "start_time", time_slot("start_time").alias("time_slot"))


# ------------------------------------------------- P11 defaults, F17-F21
@query("coalesce_defaults", """
SELECT o_orderkey,
       coalesce(CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END, 0) AS custkey,
       coalesce(CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END, 'Unknown') AS status,
       coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 300 AS INTEGER) END, 240) AS minutes
FROM orders
""")
def q_coalesce_defaults(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey",
                    X.coalesce_zero(_null_when("o_custkey", "o_orderkey", 13)).alias("custkey"),
                    F.coalesce(_null_when("o_orderstatus", "o_orderkey", 11), F.lit("Unknown"))
                    .alias("status"),
                    X.coalesce_zero(F.when(F.col("o_orderkey") % 7 != 0,
                                           (F.col("o_orderkey") % 300).cast("int")), 240)
                    .alias("minutes"))


_Q_SQL = """(o_orderkey * 3) % 15 + 20 AS q1, CASE WHEN o_orderkey % 41 <> 0 THEN (o_orderkey * 5) % 15 + 20 END AS q2,
           (o_orderkey * 7) % 15 + 20 AS q3, (o_custkey * 11) % 15 + 20 AS q4"""


def _quarters(o):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select("o_orderkey", ((k * 3) % 15 + 20).alias("q1"),
                    F.when(k % 41 != 0, (k * 5) % 15 + 20).alias("q2"),
                    ((k * 7) % 15 + 20).alias("q3"), ((c * 11) % 15 + 20).alias("q4"))


@query("row_argmax", f"""
WITH t AS (SELECT o_orderkey, {_Q_SQL} FROM orders)
SELECT o_orderkey,
       greatest(coalesce(q1, 0), coalesce(q2, 0), coalesce(q3, 0), coalesce(q4, 0)) AS max_quarter_score,
       least(coalesce(q1, 0), coalesce(q2, 0), coalesce(q3, 0), coalesce(q4, 0)) AS min_quarter_score,
       CASE WHEN greatest(coalesce(q1, 0), coalesce(q2, 0), coalesce(q3, 0), coalesce(q4, 0)) = coalesce(q1, 0) THEN 'Q1'
            WHEN greatest(coalesce(q1, 0), coalesce(q2, 0), coalesce(q3, 0), coalesce(q4, 0)) = coalesce(q2, 0) THEN 'Q2'
            WHEN greatest(coalesce(q1, 0), coalesce(q2, 0), coalesce(q3, 0), coalesce(q4, 0)) = coalesce(q3, 0) THEN 'Q3'
            ELSE 'Q4' END AS best_quarter
FROM t
""")
def q_row_argmax(spark, d):
    t = _quarters(Tables(spark, d).orders)
    qs = [X.coalesce_zero(c) for c in ("q1", "q2", "q3", "q4")]
    return t.select("o_orderkey", F.greatest(*qs).alias("max_quarter_score"),
                    F.least(*qs).alias("min_quarter_score"),
                    X.row_argmax(qs, ["Q1", "Q2", "Q3", "Q4"]).alias("best_quarter"))


@query("period_momentum", f"""
WITH t AS (SELECT o_orderkey, {_Q_SQL} FROM orders)
SELECT o_orderkey,
       coalesce(q2, 0) - coalesce(q1, 0) AS q2_momentum,
       coalesce(q3, 0) - coalesce(q2, 0) AS q3_momentum,
       coalesce(q4, 0) - coalesce(q3, 0) AS q4_momentum,
       coalesce(q1, 0) + coalesce(q2, 0) AS first_half_points
FROM t
""")
def q_period_momentum(spark, d):
    t = _quarters(Tables(spark, d).orders)
    m2, m3, m4 = X.deltas(["q1", "q2", "q3", "q4"])
    return t.select("o_orderkey", m2.alias("q2_momentum"), m3.alias("q3_momentum"),
                    m4.alias("q4_momentum"), X.safe_add("q1", "q2").alias("first_half_points"))


@query("two_side_outcome", """
WITH t AS (SELECT o_orderkey, 'H' || CAST(o_custkey % 25 AS VARCHAR) AS home, 'V' || CAST(o_custkey % 23 AS VARCHAR) AS visitor,
                  80 + (o_orderkey * 7) % 50 AS home_pts, 80 + (o_orderkey * 8) % 50 AS visitor_pts FROM orders)
SELECT o_orderkey,
       CASE WHEN home_pts > visitor_pts THEN home WHEN visitor_pts > home_pts THEN visitor END AS winning_team,
       CASE WHEN home_pts < visitor_pts THEN home WHEN visitor_pts < home_pts THEN visitor END AS losing_team,
       CASE WHEN home_pts > visitor_pts THEN 'HOME' WHEN visitor_pts > home_pts THEN 'AWAY' END AS winner_location,
       abs(home_pts - visitor_pts) AS point_differential,
       home_pts + visitor_pts AS total_points
FROM t
""")
def q_two_side_outcome(spark, d):
    o = Tables(spark, d).orders
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    t = o.select("o_orderkey", F.concat(F.lit("H"), (c % 25).cast("string")).alias("home"),
                 F.concat(F.lit("V"), (c % 23).cast("string")).alias("visitor"),
                 (80 + (k * 7) % 50).alias("home_pts"), (80 + (k * 8) % 50).alias("visitor_pts"))
    r = X.two_side_outcome("home_pts", "visitor_pts", "home", "visitor")
    return t.select("o_orderkey", r["winner"].alias("winning_team"),
                    r["loser"].alias("losing_team"), r["side"].alias("winner_location"),
                    r["abs_diff"].alias("point_differential"), r["total"].alias("total_points"))


@query("threshold_count", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS pts,
                  CASE WHEN l_partkey % 6 <> 0 THEN (l_partkey * 3) % 15 END AS trb,
                  (l_orderkey + l_partkey) % 12 AS ast, l_partkey % 11 AS stl, l_orderkey % 11 AS blk
           FROM lineitem),
c AS (SELECT *, (CASE WHEN coalesce(pts, 0) >= 10 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(trb, 0) >= 10 THEN 1 ELSE 0 END)
              + (CASE WHEN coalesce(ast, 0) >= 10 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(stl, 0) >= 10 THEN 1 ELSE 0 END)
              + (CASE WHEN coalesce(blk, 0) >= 10 THEN 1 ELSE 0 END) AS n FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, n AS categories_at_10, n >= 2 AS is_double_double, n >= 3 AS is_triple_double
FROM c
""")
def q_threshold_count(spark, d):
    li = Tables(spark, d).lineitem
    t = li.select("l_orderkey", "l_linenumber", "l_partkey",
                  F.col("l_quantity").cast("int").alias("pts"),
                  F.when(F.col("l_partkey") % 6 != 0, (F.col("l_partkey") * 3) % 15).alias("trb"),
                  ((F.col("l_orderkey") + F.col("l_partkey")) % 12).alias("ast"),
                  (F.col("l_partkey") % 11).alias("stl"), (F.col("l_orderkey") % 11).alias("blk"))
    n = X.threshold_count(["pts", "trb", "ast", "stl", "blk"], 10)
    return t.select("l_orderkey", "l_linenumber", "l_partkey", n.alias("categories_at_10"),
                    (n >= 2).alias("is_double_double"), (n >= 3).alias("is_triple_double"))


@query("ratio_metrics", """
WITH t AS (SELECT o_orderkey, 30 + (o_orderkey * 3) % 15 AS fg, CASE WHEN o_orderkey % 19 <> 0 THEN 70 + o_orderkey % 10 END AS fga,
                  5 + o_orderkey % 10 AS three_p, 10 + o_orderkey % 12 AS fta, o_orderkey % 9 AS tov, 5 + o_orderkey % 8 AS orb
           FROM orders)
SELECT o_orderkey,
       CASE WHEN coalesce(fga, 0) > 0 THEN (coalesce(fg, 0) + 0.5 * coalesce(three_p, 0)) / CAST(coalesce(fga, 0) AS DOUBLE) ELSE 0.0 END AS effective_fg_pct,
       CASE WHEN (coalesce(fga, 0) + 0.44 * coalesce(fta, 0) + coalesce(tov, 0)) > 0
            THEN coalesce(tov, 0) / (coalesce(fga, 0) + 0.44 * coalesce(fta, 0) + coalesce(tov, 0)) ELSE 0.0 END AS turnover_rate,
       CASE WHEN coalesce(tov, 0) > 0 THEN CAST(coalesce(fta, 0) AS DOUBLE) / coalesce(tov, 0) ELSE 0.0 END AS fta_per_tov
FROM t
""")
def q_ratio_metrics(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey")
    t = o.select("o_orderkey", (30 + (k * 3) % 15).alias("fg"),
                 F.when(k % 19 != 0, 70 + k % 10).alias("fga"), (5 + k % 10).alias("three_p"),
                 (10 + k % 12).alias("fta"), (k % 9).alias("tov"), (5 + k % 8).alias("orb"))
    z = X.coalesce_zero
    den = z("fga") + F.lit(0.44) * z("fta") + z("tov")
    return t.select("o_orderkey",
                    X.ratio_or_zero(z("fg") + F.lit(0.5) * z("three_p"), z("fga")).alias("effective_fg_pct"),
                    X.ratio_or_zero(z("tov"), den).alias("turnover_rate"),
                    X.ratio_or_zero(z("fta"), z("tov")).alias("fta_per_tov"))
