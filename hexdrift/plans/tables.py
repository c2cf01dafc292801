"""Queries of sources, filters, joins by key, sets, dedup and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as C
from ..operators import layers as L
from ..operators.spatial import close_pairs, near, nearest
from ..sources import model as M

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SQL = "WITH " + M.SQL + "\n"


def query(name: str, sql: str | None = None, prelude: str = ""):
    """Register a query and the SQL that checks it."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = prelude + sql
        return f

    return add


def latest(df: DataFrame, keys: list[str], by: list) -> DataFrame:
    """The last row of each key in the order ``by``, which is total."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*by))).where("_n = 1").drop("_n")




@query("s2_resolve_vintages", "SELECT CAST(year(o_orderdate) AS INT) AS vintage FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 2")
def _(spark, d):
    return M.table(spark, d, "orders").select(F.year("o_orderdate").alias("vintage")).distinct().orderBy(F.desc("vintage")).limit(2)


@query("s4_catalog_filter", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT' AND o_custkey % 5 IN (1, 2)")
def _(spark, d):
    o = M.table(spark, d, "orders")
    return o.where((F.col("o_orderstatus") != "P") & (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 5).isin(1, 2)).select("o_orderkey", "o_custkey")


@query("s5_provider_names", "SELECT k AS provider_id, coalesce(n_name, CAST(k AS VARCHAR)) AS provider FROM (SELECT DISTINCT l_suppkey % 40 AS k FROM lineitem) LEFT JOIN nation ON n_nationkey = k")
def _(spark, d):
    ids = M.table(spark, d, "lineitem").select((F.col("l_suppkey") % 40).alias("provider_id")).distinct()
    names = M.table(spark, d, "nation").select(F.col("n_nationkey").alias("provider_id"), "n_name")
    return ids.join(names, "provider_id", "left").select("provider_id", F.coalesce("n_name", F.col("provider_id").cast("string")).alias("provider"))


@query("s10_shared_scan", "SELECT l_partkey, l_suppkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_suppkey IN (1, 2, 3) AND ((l_linenumber = 1 AND l_returnflag = 'N') OR (l_linenumber = 2 AND l_returnflag = 'A')) GROUP BY ALL")
def _(spark, d):
    li = M.table(spark, d, "lineitem").withColumn("provider_id", F.col("l_suppkey"))
    kept = L.shared_scan(li, [1, 2, 3], [("N", 1), ("A", 2)], "l_returnflag", "l_linenumber")
    return kept.groupBy("l_partkey", "l_suppkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("s12_provider_membership", "SELECT p_partkey FROM part WHERE list_contains(string_split(coalesce(replace(p_type, ' ', ','), ''), ','), 'ECONOMY') OR list_contains(string_split(CAST(p_size AS VARCHAR) || ',' || CAST(p_partkey % 7 AS VARCHAR), ','), '3')")
def _(spark, d):
    p = M.table(spark, d, "part")
    words = F.regexp_replace("p_type", " ", ",")
    numbers = F.concat(F.col("p_size").cast("string"), F.lit(","), (F.col("p_partkey") % 7).cast("string"))
    return p.where(L.in_list(words, "ECONOMY") | L.in_list(numbers, 3)).select("p_partkey")


@query("s15_compose_layers", "SELECT cell, max(signal_dbm) AS signal_dbm, count(*) AS parts FROM layer GROUP BY cell", SQL)
def _(spark, d):
    layer = L.strongest(M.observations(spark, d), ["provider_id", "technology", "vintage", "cell"])
    return layer.groupBy("cell").agg(F.max("signal_dbm").alias("signal_dbm"), F.count(F.lit(1)).alias("parts"))


@query("s17_cache_completeness", "SELECT p, n_nationkey FROM range(40) t(p), nation WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 40 = p AND s_nationkey = n_nationkey)")
def _(spark, d):
    grid = spark.range(40).select(F.col("id").alias("p"), F.explode(F.sequence(F.lit(0), F.lit(24))).alias("n_nationkey"))
    have = M.table(spark, d, "supplier").select((F.col("s_suppkey") % 40).alias("p"), F.col("s_nationkey").alias("n_nationkey"))
    known = M.table(spark, d, "nation").select("n_nationkey")
    return grid.join(known, "n_nationkey", "left_semi").join(have, ["p", "n_nationkey"], "left_anti").select("p", "n_nationkey")


@query("s25_two_phase_join", """WITH co AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS u FROM customer),
ra AS (SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END AS u FROM supplier),
a AS (SELECT c_custkey, s_suppkey FROM co JOIN ra USING (u)),
b AS (SELECT c_custkey, s_suppkey FROM co JOIN ra ON c_custkey = s_suppkey + 1 WHERE c_custkey NOT IN (SELECT c_custkey FROM a) AND s_suppkey NOT IN (SELECT s_suppkey FROM a))
SELECT *, 'key' AS how FROM a UNION ALL SELECT *, 'fallback' FROM b""")
def _(spark, d):
    co = M.table(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey")).alias("u"))
    ra = M.table(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey")).alias("u"))
    first = co.join(ra, "u").select("c_custkey", "s_suppkey")
    rest = co.join(first, "c_custkey", "left_anti").join(ra.join(first, "s_suppkey", "left_anti"), F.col("c_custkey") == F.col("s_suppkey") + 1).select("c_custkey", "s_suppkey")
    return first.withColumn("how", F.lit("key")).unionByName(rest.withColumn("how", F.lit("fallback")))


@query("s27_vintage_quarter", "SELECT event_id, CAST(year(ts) AS INT) AS y, CAST((month(ts) - 1) // 3 + 1 AS INT) AS q FROM events")
def _(spark, d):
    return M.table(spark, d, "events").select("event_id", F.year("ts").alias("y"), F.quarter("ts").alias("q"))


@query("s30_latest_batch", "SELECT o_custkey, o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def _(spark, d):
    return latest(M.table(spark, d, "orders"), ["o_custkey", "o_orderstatus"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderstatus", "o_orderkey")


@query("s31_coverage_last_wins", "SELECT l_partkey, l_suppkey, l_returnflag, max(l_shipdate) AS last FROM lineitem GROUP BY ALL")
def _(spark, d):
    return M.table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey", "l_returnflag").agg(F.max("l_shipdate").alias("last"))


@query("s35_vintages_from_names", "SELECT DISTINCT CAST(regexp_extract(c_name, '^Customer#?0*([0-9]+)$', 1) AS BIGINT) AS vintage FROM customer WHERE regexp_matches(c_name, '^Customer#?0*[0-9]+$')")
def _(spark, d):
    n = F.regexp_extract("c_name", "^Customer#?0*([0-9]+)$", 1)
    return M.table(spark, d, "customer").where(n != "").select(n.cast("bigint").alias("vintage")).distinct()


@query("s37_point_lookup", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 7 AND o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 1")
def _(spark, d):
    return M.table(spark, d, "orders").where("o_custkey = 7 AND o_orderstatus = 'O'").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(1)


@query("p2_signal_coercion", "SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber WHEN 1 THEN -105e0 WHEN 2 THEN -95e0 WHEN 3 THEN -85e0 ELSE CAST(l_linenumber AS DOUBLE) END AS dbm, count(*) AS n FROM lineitem GROUP BY ALL")
def _(spark, d):
    return M.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", L.signal(F.col("l_linenumber").cast("string")).alias("dbm")).groupBy("l_orderkey", "l_linenumber", "l_partkey", "dbm").agg(F.count(F.lit(1)).alias("n"))


@query("p3_state_filter", "SELECT s_suppkey FROM supplier WHERE lpad(CAST(s_nationkey AS VARCHAR), 2, '0') IN ('01', '08', '20')")
def _(spark, d):
    return M.table(spark, d, "supplier").where(F.lpad(F.col("s_nationkey").cast("string"), 2, "0").isin("01", "08", "20")).select("s_suppkey")


@query("p5_drop_fixtures", "SELECT c_custkey FROM customer WHERE NOT (CAST(c_custkey AS VARCHAR) LIKE '90%' OR c_nationkey = 9)")
def _(spark, d):
    key = F.col("c_custkey").cast("string")
    return M.table(spark, d, "customer").where(~(key.startswith(C.FIXTURE_STATE) | (F.col("c_nationkey") == 9))).select("c_custkey")


@query("p8_finite_rounding", "SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN NULL ELSE round_even(s_acctbal / 7, 3) END AS v FROM supplier")
def _(spark, d):
    v = F.when(F.col("s_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("s_acctbal") / 7)
    return M.table(spark, d, "supplier").select("s_suppkey", F.when(~F.isnan(v), F.bround(v, 3)).alias("v"))


@query("p10_slugs", "SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM pages")
def _(spark, d):
    return M.table(spark, d, "pages").select("page_id", F.trim(F.regexp_replace(F.lower("url"), "[^a-z0-9]+", "-"), F.lit("-")).alias("slug"))


@query("p12_scope_label", "SELECT n_regionkey, string_agg(DISTINCT lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), '-' ORDER BY lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS scope FROM nation GROUP BY ALL")
def _(spark, d):
    token = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    return M.table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_set(token)), "-").alias("scope"))


@query("p13_name_filter", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size > 20 AND contains(lower(p_name), 'a')")
def _(spark, d):
    return M.table(spark, d, "part").where((F.col("p_size") > 20) & F.contains(F.lower("p_name"), F.lit("a"))).select("p_partkey", "p_name", "p_retailprice")


@query("p14_county_geoid", "SELECT s_suppkey, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') AS geoid FROM supplier")
def _(spark, d):
    z = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return M.table(spark, d, "supplier").select("s_suppkey", F.concat(z(F.col("s_nationkey"), 2), z(F.col("s_suppkey") % 1000, 3)).alias("geoid"))


@query("j2_left_joins", "SELECT c_custkey, n_name, r_name, coalesce(t.orders, 0) AS orders FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) t ON o_custkey = c_custkey")
def _(spark, d):
    c, n, r, o = (M.table(spark, d, t) for t in ("customer", "nation", "region", "orders"))
    n = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    counts = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "n_name", "r_name", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("a13_asr_window_labels", "SELECT county_geoid, count(event_date) AS structures, min(event_date) AS first, true AS has_new FROM mast WHERE event_date BETWEEN DATE '1995-07-01' - INTERVAL 90 DAY AND DATE '1995-12-31' + INTERVAL 90 DAY GROUP BY ALL", SQL)
def _(spark, d):
    day = F.col("event_date")
    inside = day.between(F.date_sub(F.lit("1995-07-01").cast("date"), C.GRACE_DAYS), F.date_add(F.lit("1995-12-31").cast("date"), C.GRACE_DAYS))
    return M.masts(spark, d).where(inside).groupBy("county_geoid").agg(F.count("event_date").alias("structures"), F.min("event_date").alias("first"), F.lit(True).alias("has_new"))


@query("j4_asr_feature_merge", "SELECT county_geoid, coalesce(n, 0) AS structures, coalesce(n > 0, false) AS has_new FROM county LEFT JOIN (SELECT county_geoid, count(event_date) AS n FROM mast WHERE event_date < DATE '1995-06-01' GROUP BY 1) USING (county_geoid)", SQL)
def _(spark, d):
    labels = M.masts(spark, d).where("event_date < DATE '1995-06-01'").groupBy("county_geoid").agg(F.count("event_date").alias("n"))
    return M.counties(spark, d, C.HEX_KM2[8]).join(labels, "county_geoid", "left").select("county_geoid", F.coalesce("n", F.lit(0)).alias("structures"), F.coalesce(F.col("n") > 0, F.lit(False)).alias("has_new"))


_MEASURED = "SELECT CAST(user_id % 20 AS INT) AS county, event_type, count(*) AS tests, round(sum(value) / greatest(count(*), 1), 6) AS dl, count(*) >= 3 AS is_measured FROM events GROUP BY ALL"


@query("a14_measurement_rollup", _MEASURED)
def _(spark, d):
    n = F.count(F.lit(1))
    return M.table(spark, d, "events").groupBy((F.col("user_id") % 20).cast("int").alias("county"), "event_type").agg(n.alias("tests"), F.round(F.sum("value") / F.greatest(n, F.lit(1)), 6).alias("dl"), (n >= C.MIN_TESTS).alias("is_measured"))


@query("j5_measurement_gap", "SELECT n_nationkey, CASE WHEN coalesce(n, 0) >= 3 THEN 0e0 ELSE round(n_nationkey / 25e0, 6) END AS gap FROM nation LEFT JOIN (SELECT user_id % 30 AS k, count(*) AS n FROM events WHERE value > 100 GROUP BY 1) ON k = n_nationkey")
def _(spark, d):
    m = M.table(spark, d, "events").where("value > 100").groupBy((F.col("user_id") % 30).alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    gap = F.when(F.coalesce("n", F.lit(0)) >= C.MIN_TESTS, 0.0).otherwise(F.round(F.col("n_nationkey") / F.lit(25.0), 6))
    return M.table(spark, d, "nation").join(m, "n_nationkey", "left").select("n_nationkey", gap.alias("gap"))


@query("j12_two_nearest_masts", "SELECT site_id, list_extract(list_sort(list(struct_pack(d := d, m := mast_id))), 1).m AS first, CASE WHEN count(*) > 1 THEN list_extract(list_sort(list(struct_pack(d := d, m := mast_id))), 2).m END AS second FROM (SELECT site_id, mast_id, round(sqrt((s.x_m - m.x_m)^2 + (s.y_m - m.y_m)^2), 3) AS d FROM site s, mast m) WHERE d <= 4000 GROUP BY ALL", SQL)
def _(spark, d):
    pairs = near(M.sites(spark, d).select("site_id", "x_m", "y_m"), M.masts(spark, d).select("mast_id", "x_m", "y_m"), 4000.0, [])
    n = F.row_number().over(W.partitionBy("site_id").orderBy("dist_m", "mast_id"))
    two = pairs.withColumn("n", n).where("n <= 2")
    pick = lambda k: F.max(F.when(F.col("n") == k, F.col("mast_id")))
    return two.groupBy("site_id").agg(pick(1).alias("first"), pick(2).alias("second"))


@query("j13_site_fringe", "SELECT s.site_id FROM site s WHERE s.home NOT LIKE '00%' AND EXISTS (SELECT 1 FROM site t WHERE t.home LIKE '00%' AND sqrt((s.x_m - t.x_m)^2 + (s.y_m - t.y_m)^2) <= 8000)", SQL)
def _(spark, d):
    s = M.sites(spark, d).select("site_id", "home", "x_m", "y_m")
    inside = s.where("home LIKE '00%'").select("x_m", "y_m")
    return near(s.where("home NOT LIKE '00%'"), inside, 8000.0, []).select("site_id").distinct()


@query("j15_close_pairs", "SELECT a.mast_id AS a, b.mast_id AS b FROM mast a JOIN mast b ON a.mast_id < b.mast_id AND sqrt((a.x_m - b.x_m)^2 + (a.y_m - b.y_m)^2) < 2000", SQL)
def _(spark, d):
    return close_pairs(M.masts(spark, d).select(F.col("mast_id").alias("id"), "x_m", "y_m"), 2000.0)


@query("a30_precision_at_radii", "SELECT count(*) AS sites, count(*) FILTER (WHERE d <= 250) AS at_250, count(*) FILTER (WHERE d <= 500) AS at_500, count(*) FILTER (WHERE d <= 1000) AS at_1000, count(*) FILTER (WHERE d <= 2000) AS at_2000, round(median(d) FILTER (WHERE d <= 2000), 4) AS median_hit FROM (SELECT site_id, min(round(sqrt((s.x_m - m.x_m)^2 + (s.y_m - m.y_m)^2), 3)) AS d FROM site s, mast m GROUP BY 1)", SQL)
def _(spark, d):
    s = M.sites(spark, d).select("site_id", "x_m", "y_m")
    best = nearest(s, M.masts(spark, d).select("mast_id", "x_m", "y_m"), 2000.0, [], ["site_id"], "mast_id")
    every = s.select("site_id").join(best, "site_id", "left")
    at = lambda r: F.count_if(F.col("dist_m") <= r).alias(f"at_{r}")
    return every.agg(F.count(F.lit(1)).alias("sites"), at(250), at(500), at(1000), at(2000), F.round(F.median("dist_m"), 4).alias("median_hit"))


@query("t20_asr_anchor", """SELECT site_id, mast_id, round(d1, 4) AS dist_m, d1 <= 750 AND (d2 IS NULL OR d2 > 750 OR d2 >= 1.5 * greatest(d1, 1)) AS snapped FROM (
SELECT site_id, min(d) AS d1, arg_min(mast_id, (d, mast_id)) AS mast_id, list_extract(list_sort(list(d)), 2) AS d2
FROM (SELECT site_id, mast_id, round(sqrt((s.x_m - m.x_m)^2 + (s.y_m - m.y_m)^2), 3) AS d FROM site s, mast m) WHERE d <= 2000 GROUP BY site_id)""", SQL)
def _(spark, d):
    pairs = near(M.sites(spark, d).select("site_id", "x_m", "y_m"), M.masts(spark, d).select("mast_id", "x_m", "y_m"), C.MATCH_RADIUS_M, [])
    n = F.row_number().over(W.partitionBy("site_id").orderBy("dist_m", "mast_id"))
    pick = lambda k, c: F.max(F.when(F.col("n") == k, F.col(c)))
    two = pairs.withColumn("n", n).where("n <= 2").groupBy("site_id").agg(pick(1, "mast_id").alias("mast_id"), pick(1, "dist_m").alias("d1"), pick(2, "dist_m").alias("d2"))
    clear = F.col("d2").isNull() | (F.col("d2") > C.SNAP_RADIUS_M) | (F.col("d2") >= C.AMBIGUITY * F.greatest("d1", F.lit(1.0)))
    return two.select("site_id", "mast_id", F.round("d1", 4).alias("dist_m"), ((F.col("d1") <= C.SNAP_RADIUS_M) & clear).alias("snapped"))


@query("j18_rounded_coordinates", "SELECT s.site_id, c.cell FROM site s JOIN cells c ON round(s.x_m, 5) = round(c.x_m, 5) AND round(s.y_m, 5) = round(c.y_m, 5)", SQL)
def _(spark, d):
    at = [F.round("x_m", 5).alias("x"), F.round("y_m", 5).alias("y")]
    return M.sites(spark, d).select("site_id", *at).join(M.cells(spark, d).select("cell", *at), ["x", "y"]).select("site_id", "cell")


@query("j19_semi_join", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(spark, d):
    c = M.table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return M.table(spark, d, "orders").join(c, "o_custkey", "left_semi").select("o_orderkey")


@query("j20_missing_units", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(spark, d):
    done = M.table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return M.table(spark, d, "customer").join(done, "c_custkey", "left_anti").select("c_custkey")


@query("j22_sites_serving_county", "SELECT DISTINCT c.county_geoid, s.site_id, s.home = c.county_geoid AS in_county FROM cells c JOIN site s ON sqrt((c.x_m - s.x_m)^2 + (c.y_m - s.y_m)^2) <= 3000 WHERE s.site_class = 'new_site'", SQL)
def _(spark, d):
    s = M.sites(spark, d).where("site_class = 'new_site'").select("site_id", "home", "x_m", "y_m")
    return near(M.cells(spark, d).select("county_geoid", "x_m", "y_m"), s, 3000.0, []).select("county_geoid", "site_id", (F.col("home") == F.col("county_geoid")).alias("in_county")).distinct()


@query("u1_union_all", "SELECT k, count(*) AS n FROM (SELECT s_nationkey AS k FROM supplier UNION ALL SELECT c_nationkey FROM customer) GROUP BY k")
def _(spark, d):
    both = M.table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).unionByName(M.table(spark, d, "customer").select(F.col("c_nationkey").alias("k")))
    return both.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("u2_union_distinct", "SELECT l_partkey AS k FROM lineitem UNION SELECT p_partkey FROM part")
def _(spark, d):
    return M.table(spark, d, "lineitem").select(F.col("l_partkey").alias("k")).union(M.table(spark, d, "part").select("p_partkey")).distinct()


_SETS = "(SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 40)", "(SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40)"


def _sets(spark, d):
    li = M.table(spark, d, "lineitem").where("l_quantity > 40")
    return [li.where(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("k")) for f in ("A", "R")]


@query("u3_intersect", f"{_SETS[0]} INTERSECT {_SETS[1]}")
def _(spark, d):
    a, b = _sets(spark, d)
    return a.intersect(b)


@query("u3_except", f"{_SETS[0]} EXCEPT {_SETS[1]}")
def _(spark, d):
    a, b = _sets(spark, d)
    return a.subtract(b)


@query("u4_mask_iou", "SELECT CASE WHEN count(*) FILTER (WHERE a OR b) = 0 THEN 1e0 ELSE round(count(*) FILTER (WHERE a AND b) / CAST(count(*) FILTER (WHERE a OR b) AS DOUBLE), 6) END AS iou FROM (SELECT p_size > 10 AS a, p_retailprice > 1000 AS b FROM part)")
def _(spark, d):
    a, b = F.col("p_size") > 10, F.col("p_retailprice") > 1000
    either = F.count_if(a | b)
    return M.table(spark, d, "part").agg(F.when(either == 0, 1.0).otherwise(F.round(F.count_if(a & b) / F.nullif(either, F.lit(0)), 6)).alias("iou"))


@query("u5_mixed_vintage_guard", "SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus <> 'O'")
def _(spark, d):
    return M.table(spark, d, "orders").select("o_orderstatus").distinct().where("o_orderstatus <> 'O'")


@query("u6_drop_duplicate_sites", "SELECT s_nationkey, k, max(s_suppkey) AS s_suppkey FROM (SELECT *, s_suppkey % 4 AS k FROM supplier) GROUP BY ALL")
def _(spark, d):
    s = M.table(spark, d, "supplier").withColumn("k", F.col("s_suppkey") % 4)
    return latest(s, ["s_nationkey", "k"], [F.desc("s_suppkey")]).select("s_nationkey", "k", "s_suppkey")


@query("w7_top_per_group", "SELECT n_regionkey, s_suppkey FROM (SELECT n_regionkey, s_suppkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY s_acctbal DESC, s_suppkey) AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey) WHERE k <= 3")
def _(spark, d):
    s = M.table(spark, d, "supplier").join(M.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.row_number().over(W.partitionBy("n_regionkey").orderBy(F.desc("s_acctbal"), "s_suppkey"))
    return s.withColumn("k", k).where("k <= 3").select("n_regionkey", "s_suppkey")


@query("g6_parent_child_bits", "SELECT k, (h & ~(15::BIGINT << 52)) | (8::BIGINT << 52) | 2097151 AS parent, ((((h & ~(15::BIGINT << 52)) | (8::BIGINT << 52) | 2097151) & ~(1835008::BIGINT)) & ~(15::BIGINT << 52)) | (9::BIGINT << 52) AS center FROM (SELECT p_partkey AS k, (1::BIGINT << 59) | (9::BIGINT << 52) | (p_partkey % 122 << 45) | (((p_partkey * 7919) % 134217728) << 18) | 262143 AS h FROM part)")
def _(spark, d):
    h = F.expr("(1L << 59) | (9L << 52) | ((p_partkey % 122) << 45) | (((p_partkey * 7919) % 134217728) << 18) | 262143L")
    p = M.table(spark, d, "part").select(F.col("p_partkey").alias("k"), h.alias("h")).select("k", L.parent(F.col("h"), 8).alias("parent"))
    return p.select("k", "parent", L.center_child(F.col("parent"), 8, 9).alias("center"))


@query("g12_display_signal", "SELECT site_id, round(greatest(-120e0, -65 - 25 * log10(1 + n_hexes)), 6) AS dbm, CAST(greatest(-128, least(127, round_even(greatest(-120e0, -65 - 25 * log10(1 + n_hexes)), 0) + 100)) AS INT) AS encoded FROM site", SQL)
def _(spark, d):
    dbm = F.greatest(F.lit(-120.0), F.lit(-65.0) - 25 * F.log10(F.lit(1.0) + F.col("n_hexes")))
    return M.sites(spark, d).select("site_id", F.round(dbm, 6).alias("dbm"), F.greatest(F.lit(-128.0), F.least(F.lit(127.0), F.bround(dbm) + 100)).cast("int").alias("encoded"))


@query("j9_buffer_semi", "SELECT c.cell FROM cells c WHERE EXISTS (SELECT 1 FROM cells t WHERE t.state_fips = '01' AND sqrt((c.x_m - t.x_m)^2 + (c.y_m - t.y_m)^2) <= 2500)", SQL)
def _(spark, d):
    c = M.cells(spark, d).select("cell", "state_fips", "x_m", "y_m")
    return near(c.select("cell", "x_m", "y_m"), c.where("state_fips = '01'").select("x_m", "y_m"), 2500.0, []).select("cell").distinct()


@query("k16_render_extent", "SELECT county_geoid, round(min(x_m) - 0.18e0 * (max(x_m) - min(x_m)), 4) AS x0, round(max(x_m) + 0.18e0 * (max(x_m) - min(x_m)), 4) AS x1, round(min(y_m) - 0.18e0 * (max(y_m) - min(y_m)), 4) AS y0, round(max(y_m) + 0.18e0 * (max(y_m) - min(y_m)), 4) AS y1 FROM cells GROUP BY ALL", SQL)
def _(spark, d):
    lo, hi = (lambda c: F.min(c)), (lambda c: F.max(c))
    out = []
    for c in ("x", "y"):
        m = F.lit(0.18) * (hi(f"{c}_m") - lo(f"{c}_m"))
        out += [F.round(lo(f"{c}_m") - m, 4).alias(f"{c}0"), F.round(hi(f"{c}_m") + m, 4).alias(f"{c}1")]
    return M.cells(spark, d).groupBy("county_geoid").agg(*out)


@query("f_props_json", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INT)) AS BIGINT) AS total FROM events GROUP BY ALL")
def _(spark, d):
    k = F.from_json("props", "k int")["k"]
    return M.table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).cast("bigint").alias("total"))


@query("f_equirectangular", "SELECT s_suppkey, round(sqrt(pow((s_nationkey / 10e0) * 110.57e0, 2) + pow((s_suppkey % 10) / 10e0 * 111.32e0 * cos(radians(s_nationkey)), 2)), 6) AS km FROM supplier")
def _(spark, d):
    y = F.col("s_nationkey") / F.lit(10.0) * 110.57
    x = F.col("s_suppkey") % 10 / F.lit(10.0) * 111.32 * F.cos(F.radians("s_nationkey"))
    return M.table(spark, d, "supplier").select("s_suppkey", F.round(F.hypot(y, x), 6).alias("km"))
