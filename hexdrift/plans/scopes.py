"""Queries of scopes, names, labels, documents for the web and raster cells."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import layers as L
from ..operators import scope as P
from ..sources import model as M
from . import coverage

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
UNIT = L.UNIT
KEY = [*UNIT, "county_geoid"]


def query(name: str, sql: str, prelude: str = ""):
    """Register a query and the SQL that checks it."""

    def add(f):
        QUERIES[name] = f
        ORACLES[name] = prelude + sql
        return f

    return add


@query("s3_catalog_order", """SELECT vintage, CAST(filed AS DATE) AS filed, CAST(row_number() OVER (ORDER BY filed DESC NULLS LAST, vintage) AS INT) AS place FROM (
SELECT vintage, coalesce(try_strptime(vintage, '%Y-%m-%d'), try_strptime(vintage, '%m/%d/%Y')) AS filed FROM (
SELECT DISTINCT CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 1 THEN strftime(o_orderdate, '%m/01/%Y') ELSE o_orderstatus END AS vintage FROM orders))""")
def _(spark, d):
    o = M.table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-01")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "MM/01/yyyy")).otherwise(F.col("o_orderstatus"))
    filed = F.coalesce(F.try_to_timestamp("vintage", F.lit("yyyy-MM-dd")), F.try_to_timestamp("vintage", F.lit("MM/dd/yyyy"))).cast("date")
    rows = o.select(text.alias("vintage")).distinct().select("vintage", filed.alias("filed"))  # one row a release
    return rows.withColumn("place", F.row_number().over(W.orderBy(F.col("filed").desc_nulls_last(), "vintage")))


@query("s11_legacy_flags", "SELECT l_orderkey, l_linenumber, CAST(l_linenumber = 1 AS TINYINT) AS env0, CAST(l_returnflag = 'R' AS TINYINT) AS env1 FROM lineitem WHERE (l_linenumber = 1 OR l_returnflag = 'R') AND l_suppkey % 4 IN (0, 2)")
def _(spark, d):
    li = M.table(spark, d, "lineitem").where(((F.col("l_linenumber") == 1) | (F.col("l_returnflag") == "R")) & (F.col("l_suppkey") % 4).isin(0, 2))
    return li.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") == 1).cast("byte").alias("env0"), (F.col("l_returnflag") == "R").cast("byte").alias("env1"))


@query("s16_prefetch_plan", "SELECT s_nationkey, CASE WHEN count(DISTINCT s_suppkey % 4) = 1 THEN 'DIRECT' ELSE 'SHARED' END AS mode, CAST(least(3, count(DISTINCT s_suppkey % 4)) AS INT) AS workers FROM supplier GROUP BY s_nationkey")
def _(spark, d):
    n = F.count_distinct(F.col("s_suppkey") % 4)
    return M.table(spark, d, "supplier").groupBy("s_nationkey").agg(F.when(n == 1, "DIRECT").otherwise("SHARED").alias("mode"), F.least(F.lit(3), n).cast("int").alias("workers"))


@query("s29_batch_selection", """SELECT * FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN 'all' ELSE lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || '-' || lpad(CAST((s_nationkey + 3) % 25 AS VARCHAR), 2, '0') END AS batch FROM supplier)
WHERE list_contains(string_split(batch, '-'), '04') OR list_contains(string_split(batch, '-'), 'all')""")
def _(spark, d):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    name = F.when(F.col("s_suppkey") % 7 == 0, "all").otherwise(F.concat(two(F.col("s_nationkey")), F.lit("-"), two((F.col("s_nationkey") + 3) % 25)))
    return P.batches_of(M.table(spark, d, "supplier").select("s_suppkey", name.alias("batch")), "batch", "04")


@query("s36_release_lookup", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '2-HIGH' OR CAST(CAST(o_orderdate AS DATE) AS VARCHAR) = '2-HIGH' ORDER BY o_orderkey LIMIT 1")
def _(spark, d):
    o = M.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("as_of"))
    return P.release(o, "2-HIGH", "o_orderpriority", "as_of", "o_orderkey").drop("as_of")


@query("s43_structures_only", "SELECT c_custkey AS unique_id, c_acctbal AS height_m, '' AS registration_number, CAST(NULL AS DATE) AS date_constructed FROM customer")
def _(spark, d):
    return M.table(spark, d, "customer").select(F.col("c_custkey").alias("unique_id"), F.col("c_acctbal").alias("height_m"), F.lit("").alias("registration_number"), F.lit(None).cast("date").alias("date_constructed"))


@query("p4_target_rows", "SELECT provider_id, technology, county_geoid FROM scored WHERE state_fips IN ('00', '02')", coverage.SQL)
def _(spark, d):
    return P.in_states(coverage.scored(spark, d).select(*KEY, "state_fips"), ["00", "02"]).drop("state_fips")


@query("p9_whole_numbers", "SELECT k, CAST(CASE WHEN v IS NULL OR NOT isfinite(v) THEN 0 ELSE trunc(v) END AS INT) AS n FROM (SELECT p_partkey AS k, TRY_CAST(CASE p_partkey % 5 WHEN 0 THEN '12.9' WHEN 1 THEN 'NaN' WHEN 2 THEN NULL WHEN 3 THEN 'abc' ELSE '-7.2' END AS DOUBLE) AS v FROM part)")
def _(spark, d):
    raw = F.element_at(F.array(F.lit("12.9"), F.lit("NaN"), F.lit(None), F.lit("abc"), F.lit("-7.2")), (F.col("p_partkey") % 5 + 1).cast("int"))
    return M.table(spark, d, "part").select(F.col("p_partkey").alias("k"), P.whole(raw).alias("n"))


@query("p10_safe_names", """SELECT k, regexp_replace(regexp_replace(x, '[^A-Za-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g') AS run_key,
CASE WHEN t = '' THEN 'unknown' ELSE t END AS tag, regexp_replace(replace(x, '/', '-'), '[ ()]', '', 'g') AS service
FROM (SELECT *, regexp_replace(regexp_replace(trim(x), '[^\\w.\\-]+', '_', 'g'), '^_+|_+$', '', 'g') AS t
FROM (SELECT p_partkey AS k, CASE WHEN p_partkey % 11 = 0 THEN ' / ' ELSE '(' || p_type || ')/ ' || p_brand END AS x FROM part))""")
def _(spark, d):
    x = F.when(F.col("p_partkey") % 11 == 0, " / ").otherwise(F.concat(F.lit("("), "p_type", F.lit(")/ "), "p_brand"))
    return M.table(spark, d, "part").select(F.col("p_partkey").alias("k"), P.run_key(x).alias("run_key"), P.tag(x).alias("tag"), P.service_name(x).alias("service"))


@query("p11_run_scope", "SELECT provider_id, technology, count(*) AS n FROM obs WHERE provider_id IN (1, 3) AND technology IN ('N', 'R') GROUP BY ALL", coverage.SQL)
def _(spark, d):
    o = M.observations(spark, d).where(F.col("provider_id").isin(1, 3) & F.col("technology").isin("N", "R"))
    return o.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("n"))


@query("p15_provider_scope", "SELECT DISTINCT 'all' AS scope, provider_id FROM obs UNION ALL SELECT DISTINCT 'list', provider_id FROM obs WHERE provider_id IN (0, 2, 9)", coverage.SQL)
def _(spark, d):
    o = M.observations(spark, d)
    every, some = P.providers(o, None), P.providers(o, [0, 2, 9])
    return every.select(F.lit("all").alias("scope"), "provider_id").unionByName(some.select(F.lit("list").alias("scope"), "provider_id"))


@query("p16_scope_keys", """SELECT k, CASE WHEN len(t) = 0 OR (len(t) = 1 AND lower(t[1]) = 'all') THEN 'all' ELSE array_to_string(list_sort(list_transform(t, lambda x: CASE WHEN length(x) < 2 THEN lpad(x, 2, '0') ELSE x END)), '-') END AS scope
FROM (SELECT n_nationkey AS k, list_filter(list_transform(string_split(CASE n_nationkey % 5 WHEN 0 THEN ' ALL ' WHEN 1 THEN ' ,' ELSE n_nationkey || ' , ' || (n_nationkey * 7 % 25) || ',,3 ' END, ','), lambda x: trim(x)), lambda x: x <> '') AS t FROM nation)""")
def _(spark, d):
    k = F.col("n_nationkey")
    raw = F.when(k % 5 == 0, " ALL ").when(k % 5 == 1, " ,").otherwise(F.concat(k.cast("string"), F.lit(" , "), (k * 7 % 25).cast("string"), F.lit(",,3 ")))
    return M.table(spark, d, "nation").select(k.alias("k"), P.scope_key(raw).alias("scope"))


@query("p17_demo_landing", "SELECT coalesce(bool_or(starts_with(county_geoid, '90')), false) AS demo FROM scored", coverage.SQL)
def _(spark, d):
    return coverage.scored(spark, d).agg(F.coalesce(F.bool_or(F.startswith("county_geoid", F.lit("90"))), F.lit(False)).alias("demo"))


@query("p18_severity_of_score", """SELECT provider_id, technology, county_geoid, CASE WHEN s >= 0.7 THEN 'Top 1%' WHEN s >= 0.55 THEN 'Top 5%' WHEN s >= 0.4 THEN 'Top 10%' WHEN flag_for_review THEN 'Flagged' ELSE 'Below threshold' END AS severity
FROM (SELECT *, round(priority_score, 9) AS s FROM scored)""", coverage.SQL)
def _(spark, d):
    return coverage.scored(spark, d).select(*KEY, P.severity_of_score(F.round("priority_score", 9), F.col("flag_for_review")).alias("severity"))


@query("j6_labels_on_present_keys", "SELECT provider_id, technology, county_geoid, label FROM scored JOIN (SELECT provider_id, home AS county_geoid, count(*) AS label FROM site GROUP BY ALL) USING (provider_id, county_geoid)", coverage.SQL)
def _(spark, d):
    labels = M.sites(spark, d).groupBy("provider_id", F.col("home").alias("county_geoid")).agg(F.count(F.lit(1)).alias("label"))
    return P.join_present(coverage.scored(spark, d).select(*KEY), labels, ["provider_id", "county_geoid", "technology"])


@query("j23_service_columns", "SELECT l_returnflag AS service, count(*) AS n, CASE l_returnflag WHEN 'A' THEN 'lte' WHEN 'N' THEN 'nr' ELSE 'umts' END || '_env0' AS hex_column FROM lineitem GROUP BY ALL")
def _(spark, d):
    n = M.table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("service")).agg(F.count(F.lit(1)).alias("n"))
    return P.service_columns(n, {"A": "lte", "N": "nr", "R": "umts"}, 0)


@query("j17_county_centres", "SELECT c.county_geoid, x, y FROM county c JOIN (SELECT county_geoid, round(avg(x_m), 3) AS x, round(avg(y_m), 3) AS y FROM cells GROUP BY 1) USING (county_geoid)", coverage.SQL)
def _(spark, d):
    centres = M.cells(spark, d).groupBy("county_geoid").agg(F.round(F.avg("x_m"), 3).alias("x"), F.round(F.avg("y_m"), 3).alias("y"))
    return M.counties(spark, d, coverage.KM2).select("county_geoid").join(centres, "county_geoid")


@query("a4_polyfill_fold", "SELECT provider_id, technology, cell, CASE WHEN technology = 'R' THEN 0e0 ELSE max(signal_dbm) END AS signal_dbm FROM obs GROUP BY provider_id, technology, cell", coverage.SQL)
def _(spark, d):
    value = F.when(F.col("technology") == "R", F.lit(0.0)).otherwise(F.col("signal_dbm"))
    return L.strongest(M.observations(spark, d).withColumn("signal_dbm", value), [*UNIT, "cell"])


@query("a5_parent_rollup", """SELECT (h & ~(15::BIGINT << 52)) | (8::BIGINT << 52) | 2097151 AS parent, max(p_retailprice) AS strongest, count(*) AS n
FROM (SELECT *, (1::BIGINT << 59) | (9::BIGINT << 52) | (p_partkey % 122 << 45) | (((p_partkey * 7919) % 512) << 18) | 262143 AS h FROM part) GROUP BY 1""")
def _(spark, d):
    h = F.expr("(1L << 59) | (9L << 52) | ((p_partkey % 122) << 45) | (((p_partkey * 7919) % 512) << 18) | 262143L")
    return M.table(spark, d, "part").groupBy(L.parent(h, 8).alias("parent")).agg(F.max("p_retailprice").alias("strongest"), F.count(F.lit(1)).alias("n"))


@query("a28_flat_units", "SELECT provider_id, technology, county_geoid, count(DISTINCT signal_dbm) <= 1 AS flat FROM layer JOIN cells USING (cell) WHERE vintage = 'current' GROUP BY ALL", coverage.SQL)
def _(spark, d):
    layer = M.with_geo(L.strongest(M.observations(spark, d).where("vintage = 'current'"), [*UNIT, "cell"]), "county_geoid")
    return layer.groupBy(*KEY).agg((F.count_distinct("signal_dbm") <= 1).alias("flat"))


@query("a31_median_gates", "SELECT provider_id, round(median(added_km2), 6) AS added, round(median(same_site_growth_share), 6) AS same, median(same_site_growth_share) <= 0.5 AS passed FROM scored GROUP BY provider_id", coverage.SQL)
def _(spark, d):
    same = F.median("same_site_growth_share")
    return coverage.scored(spark, d).groupBy("provider_id").agg(F.round(F.median("added_km2"), 6).alias("added"), F.round(same, 6).alias("same"), (same <= 0.5).alias("passed"))


@query("a35_sites_of_county", "SELECT DISTINCT provider_id, county_geoid, site_id FROM attr WHERE site_id IS NOT NULL", coverage.SQL)
def _(spark, d):
    return coverage.attributed(spark, d).where("site_id IS NOT NULL").select("provider_id", "county_geoid", "site_id").distinct()


@query("w5_prefer_current", "SELECT provider_id, technology, cell, coalesce(signal_current, signal_prior) AS signal_dbm FROM change", coverage.SQL)
def _(spark, d):
    return coverage.change(spark, d).select(*UNIT, "cell", F.coalesce("signal_current", "signal_prior").alias("signal_dbm"))


@query("l4_sample_counties", "SELECT provider_id, technology, county_geoid FROM scored ORDER BY flag_for_review DESC, round(priority_score, 9) DESC, provider_id, technology, county_geoid LIMIT 20", coverage.SQL)
def _(spark, d):
    return coverage.scored(spark, d).orderBy(F.desc("flag_for_review"), *coverage.in_order()).select(*KEY).limit(20)


@query("k8_dashboard", "SELECT provider_id, technology, county_geoid, x, y, flag_for_review FROM scored JOIN (SELECT county_geoid, round(avg(x_m), 3) AS x, round(avg(y_m), 3) AS y FROM cells GROUP BY 1 HAVING count(*) >= 50) USING (county_geoid)", coverage.SQL)
def _(spark, d):
    """Counties without a centre (here those of few cells) are not shown."""
    centres = M.cells(spark, d).groupBy("county_geoid").agg(F.round(F.avg("x_m"), 3).alias("x"), F.round(F.avg("y_m"), 3).alias("y"), F.count(F.lit(1)).alias("n"))
    return coverage.scored(spark, d).select(*KEY, "flag_for_review").join(centres.where("n >= 50").drop("n"), "county_geoid")


@query("k13_sites_by_provider", "SELECT provider_id, count(*) AS n, string_agg(CAST(site_id AS VARCHAR), ',' ORDER BY site_id) AS sites FROM site GROUP BY provider_id", coverage.SQL)
def _(spark, d):
    ids = F.transform(F.sort_array(F.collect_list("site_id")), lambda x: x.cast("string"))
    return M.sites(spark, d).groupBy("provider_id").agg(F.count(F.lit(1)).alias("n"), F.array_join(ids, ",").alias("sites"))


@query("k17_county_slice", "SELECT provider_id, technology, county_geoid, round(added_km2, 6) AS added_km2, flag_for_review FROM scored WHERE provider_id = 1 AND technology = 'N' ORDER BY round(priority_score, 9) DESC, county_geoid LIMIT 1", coverage.SQL)
def _(spark, d):
    rows = coverage.scored(spark, d).where("provider_id = 1 AND technology = 'N'").orderBy(*coverage.in_order()).limit(1)
    return rows.select(*KEY, F.round("added_km2", 6).alias("added_km2"), "flag_for_review")


@query("k20_scored_counties", "SELECT county_geoid, round(county_area_km2, 6) AS area FROM county WHERE county_geoid IN (SELECT county_geoid FROM scored WHERE flag_for_review)", coverage.SQL)
def _(spark, d):
    flagged = coverage.scored(spark, d).where("flag_for_review").select("county_geoid")
    return M.counties(spark, d, coverage.KM2).join(flagged, "county_geoid", "left_semi").select("county_geoid", F.round("county_area_km2", 6).alias("area"))


_PIXELS = "(SELECT p_partkey AS k, p_partkey * 37 % 256 AS r, p_partkey * 91 % 256 AS g, p_partkey * 17 % 256 AS b, p_size FROM part)"
_SIGNAL = f"""(SELECT *, CASE WHEN hue > 0.2 AND hue < 0.45 AND depth > 0.2 AND high > 0.2 THEN CASE WHEN depth * high >= 0.85 THEN -85e0 WHEN depth * high >= 0.55 THEN -95e0 ELSE -105e0 END END AS dbm
FROM (SELECT *, CASE WHEN gap > 0 THEN (CASE WHEN high = r THEN ((g - b) / gap + 6) % 6 WHEN high = g THEN (b - r) / gap + 2 ELSE (r - g) / gap + 4 END) / 6e0 END AS hue, CASE WHEN high > 0 THEN gap / high ELSE 0 END AS depth
FROM (SELECT k, p_size, r / 255e0 AS r, g / 255e0 AS g, b / 255e0 AS b, greatest(r, g, b) / 255e0 AS high, (greatest(r, g, b) - least(r, g, b)) / 255e0 AS gap FROM {_PIXELS})))"""


def _pixels(spark, d):
    colour = lambda m: (F.col("p_partkey") * m % 256).cast("double")
    return M.table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_size", P.green_signal(colour(37), colour(91), colour(17)).alias("dbm"))


@query("g13_green_segments", f"SELECT k, dbm FROM {_SIGNAL}")
def _(spark, d):
    return _pixels(spark, d).select("k", "dbm")


@query("g14_reconcile_tiles", f"""SELECT tile, CASE WHEN u = 0 THEN 1e0 ELSE round(i / u, 6) END AS iou, CASE WHEN u = 0 OR i >= 0.8 * u THEN 'vector' ELSE 'cv' END AS source
FROM (SELECT k % 50 AS tile, count(*) FILTER (WHERE dbm IS NOT NULL AND p_size > 25) AS i, count(*) FILTER (WHERE dbm IS NOT NULL OR p_size > 25) AS u FROM {_SIGNAL} GROUP BY 1)""")
def _(spark, d):
    seen, drawn = F.col("dbm").isNotNull(), F.col("p_size") > 25
    t = _pixels(spark, d).groupBy((F.col("k") % 50).alias("tile")).agg(F.count_if(seen & drawn).alias("i"), F.count_if(seen | drawn).alias("u"))
    empty = F.col("u") == 0
    return t.select("tile", F.when(empty, 1.0).otherwise(F.round(F.try_divide("i", "u"), 6)).alias("iou"), F.when(empty | (F.col("i") >= 0.8 * F.col("u")), "vector").otherwise("cv").alias("source"))


@query("g15_quadkeys", """SELECT k, round((x + 0.5) / 64 * 360 - 180, 6) AS lng, round(degrees(atan(sinh(pi() * (1 - 2 * (y + 0.5) / 64)))), 6) AS lat
FROM (SELECT p_partkey AS k, list_sum(list_transform(range(6), lambda i: ((c >> (2 * i)) & 1) << i)) AS x, list_sum(list_transform(range(6), lambda i: ((c >> (2 * i + 1)) & 1) << i)) AS y FROM (SELECT p_partkey, p_partkey % 4096 AS c FROM part))""")
def _(spark, d):
    code = F.col("p_partkey") % 4096
    key = F.concat(*[F.shiftright(code, 2 * i).bitwiseAND(F.lit(3)).cast("string") for i in reversed(range(6))])
    p = M.table(spark, d, "part").select(F.col("p_partkey").alias("k"), key.alias("key"))
    at = P.quadkey_point(F.col("key"))
    return p.select("k", F.round(at["lng"], 6).alias("lng"), F.round(at["lat"], 6).alias("lat"))


@query("c5_site_counts", "SELECT provider_id, coalesce(CASE WHEN provider_id % 2 = 1 THEN count(*) + 100 END, count(*)) AS towers FROM site GROUP BY provider_id", coverage.SQL)
def _(spark, d):
    """A stated count, or the length of the list where none is stated."""
    rows = M.sites(spark, d).groupBy("provider_id").agg(F.collect_list("site_id").alias("sites"))
    stated = F.when(F.col("provider_id") % 2 == 1, F.size("sites") + 100)
    return rows.select("provider_id", F.coalesce(stated, F.size("sites")).cast("bigint").alias("towers"))


@query("c6_physics_label", """SELECT provider_id, technology, county_geoid, CASE WHEN sel IS NULL THEN NULL WHEN added_km2 < 10 THEN false WHEN new_site_share >= 0.5 AND new_towers >= 1 THEN false
WHEN sel THEN same_site_growth_share >= 0.5 AND (added_frac_of_county >= 0.05 OR blanket_fillin >= 0.2) ELSE same_site_growth_share >= 0.5 AND added_frac_of_county >= 0.15 END AS label
FROM (SELECT *, CASE provider_id % 3 WHEN 1 THEN true WHEN 2 THEN false END AS sel FROM scored)""", coverage.SQL)
def _(spark, d):
    selected = F.when(F.col("provider_id") % 3 == 1, True).when(F.col("provider_id") % 3 == 2, False)
    return coverage.scored(spark, d).select(*KEY, P.physics_label(selected).alias("label"))
