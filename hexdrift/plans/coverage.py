"""Queries of the main line: layers, change, attribution, score, ranking."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as C
from ..operators import attribution as A
from ..operators import change as H
from ..operators import layers as L
from ..operators import score as S
from ..sources import model as M

KM2 = C.HEX_KM2[8]
UNIT = L.UNIT


def _r(*names: str) -> list[Column]:
    return [F.round(F.col(n), 6).alias(n) for n in names]


def change(spark: SparkSession, d: str) -> DataFrame:
    """Cell changes of all units, with the cell's place."""
    return M.with_geo(H.observed_change(M.observations(spark, d), [*UNIT, "cell"]), "county_geoid", "state_fips", "x_m", "y_m", "q", "r")


def county(spark: SparkSession, d: str) -> DataFrame:
    return H.county_change(change(spark, d), M.counties(spark, d, KM2))


def attributed(spark: SparkSession, d: str) -> DataFrame:
    return A.attribute_cells(change(spark, d), M.sites(spark, d))


def boundary(spark: SparkSession, d: str) -> DataFrame:
    """Share of new cells in the outermost ring of their county."""
    edge = (F.col("q") % 10).isin(0, 9) | (F.col("r") % 10).isin(0, 9)
    new = change(spark, d).where("status = 'new'")
    return new.groupBy(*UNIT, "county_geoid").agg(F.avg(edge.cast("int")).alias("boundary_snap_share"))


def feats(spark: SparkSession, d: str) -> DataFrame:
    return S.features(county(spark, d), A.county_attribution(attributed(spark, d)), boundary(spark, d))


def scored(spark: SparkSession, d: str) -> DataFrame:
    return S.scored(feats(spark, d))


def in_order() -> list[Column]:
    """The total order of the review list."""
    return [F.desc(F.round("priority_score", 9)), F.col("provider_id"), F.col("technology"), F.col("county_geoid")]


SQL = (
    "WITH "
    + M.SQL
    + f"""
, gained AS (SELECT * FROM change WHERE status IN ('new', 'upgraded')),
near AS (
  SELECT g.provider_id, g.technology, g.cell, arg_min(struct_pack(d := d, site_id := site_id, reach := reach_m, class := site_class, home := home), (d, site_id)) AS b
  FROM (SELECT g.provider_id, g.technology, g.cell, round(sqrt((g.x_m - s.x_m) * (g.x_m - s.x_m) + (g.y_m - s.y_m) * (g.y_m - s.y_m)), 3) AS d, s.site_id, s.reach_m, s.site_class, s.home
        FROM gained g JOIN site s ON g.provider_id = s.provider_id) g
  GROUP BY ALL
),
attr AS (
  SELECT g.provider_id, g.technology, g.cell, g.county_geoid,
         CASE WHEN b.d <= b.reach THEN b.site_id END AS site_id,
         CASE WHEN b.d <= b.reach THEN b.class ELSE 'unattributed' END AS attribution,
         CASE WHEN b.d <= b.reach THEN b.home END AS home
  FROM gained g LEFT JOIN near n ON g.provider_id = n.provider_id AND g.technology = n.technology AND g.cell = n.cell
),
att AS (
  SELECT provider_id, technology, county_geoid,
         count(*) FILTER (WHERE attribution = 'new_site') * {KM2}e0 AS added_new,
         count(*) FILTER (WHERE attribution = 'expanded_site') * {KM2}e0 AS added_exp,
         count(*) FILTER (WHERE attribution = 'unattributed') * {KM2}e0 AS added_un,
         count(DISTINCT CASE WHEN attribution = 'new_site' THEN site_id END) AS new_towers,
         count(DISTINCT CASE WHEN attribution = 'new_site' AND home = county_geoid THEN site_id END) AS new_in
  FROM attr GROUP BY ALL
),
bnd AS (
  SELECT provider_id, technology, county_geoid, avg(CASE WHEN q % 10 IN (0, 9) OR r % 10 IN (0, 9) THEN 1e0 ELSE 0e0 END) AS boundary_snap_share
  FROM change WHERE status = 'new' GROUP BY ALL
),
feat0 AS (
  SELECT cc.*, coalesce(added_new, 0e0) AS an, coalesce(added_exp, 0e0) AS ae, coalesce(added_un, 0e0) AS au,
         coalesce(new_towers, 0) AS nt, coalesce(new_in, 0) AS ni, coalesce(boundary_snap_share, 0e0) AS bs,
         greatest(added_frac, 0e0) AS af, greatest(pct_increase, 0e0) AS jump,
         least(greatest(prior_cov_frac, 0e0), 1e0) AS lo, least(greatest(current_cov_frac, 0e0), 1e0) AS hi
  FROM cc LEFT JOIN att USING (provider_id, technology, county_geoid) LEFT JOIN bnd USING (provider_id, technology, county_geoid)
),
feat AS (
  SELECT provider_id, technology, county_geoid, state_fips, added_km2, pct_increase, af AS added_frac_of_county,
         CASE WHEN isinf(jump) THEN 1e0 ELSE jump / (jump + 1) END * least(af / 0.05e0, 1e0) AS coverage_increase_magnitude,
         least(greatest(greatest(hi - lo, 0e0) * (1 - lo), 0e0), 1e0) AS blanket_fillin,
         ae / greatest(an + ae + au, 1e-9) AS same_site_growth_share, au / greatest(an + ae + au, 1e-9) AS unattributed_share,
         bs AS boundary_snap_share, an / greatest(an + ae + au, 1e-9) AS new_site_share,
         greatest(mean_signal_delta, 0e0) AS signal_jump_implausibility,
         CAST(nt AS INT) AS new_towers, CAST(ni AS INT) AS new_towers_in_county, CAST(nt - ni AS INT) AS new_towers_cross_border
  FROM feat0
),
con AS (
  SELECT *, 0.25e0 * least(greatest(added_frac_of_county / 0.15e0, 0e0), 1e0) / 1.01e0 AS c1,
         0.10e0 * least(coverage_increase_magnitude, 1e0) / 1.01e0 AS c2, 0.14e0 * blanket_fillin / 1.01e0 AS c3,
         0.22e0 * same_site_growth_share / 1.01e0 AS c4, 0.08e0 * boundary_snap_share / 1.01e0 AS c6,
         0.22e0 * (1 - least(new_site_share, 1e0)) / 1.01e0 AS c7
  FROM feat
),
scored AS (
  SELECT *, 0e0 + c1 + c2 + c3 + c4 + c6 + c7 AS priority_score,
         added_km2 >= 10 AND same_site_growth_share >= 0.5 AND (added_frac_of_county >= 0.075 OR blanket_fillin >= 0.2 OR unattributed_share >= 1.01)
           AND NOT (new_site_share >= 0.5 AND new_towers >= 1)
           AND NOT (new_site_share >= 0.35 AND new_towers >= 1 AND new_towers_cross_border >= 1) AS flag_for_review,
         concat_ws('; ',
           CASE WHEN added_frac_of_county >= 0.10 THEN '+' || CAST(CAST(round(added_frac_of_county * 100) AS INT) AS VARCHAR) || '% of county newly covered' END,
           CASE WHEN blanket_fillin >= 0.30 THEN 'rapid blanket fill-in from low baseline' END,
           CASE WHEN same_site_growth_share >= 0.5 THEN CAST(CAST(round(same_site_growth_share * 100) AS INT) AS VARCHAR) || '% of growth claimed from existing sites' END,
           CASE WHEN unattributed_share >= 0.3 THEN CAST(CAST(round(unattributed_share * 100) AS INT) AS VARCHAR) || '% of new coverage far from any inferred tower' END,
           CASE WHEN boundary_snap_share >= 0.4 THEN CAST(CAST(round(boundary_snap_share * 100) AS INT) AS VARCHAR) || '% of new coverage hugs county boundary' END,
           CASE WHEN coverage_increase_magnitude >= 1.0 THEN CASE WHEN isinf(pct_increase) THEN 'coverage in previously-uncovered area'
             ELSE 'coverage up ' || CAST(CAST(round(pct_increase * 100) AS INT) AS VARCHAR) || '%' END END) AS said
  FROM con
),
ranked AS (
  SELECT *, CASE WHEN said = '' THEN 'ranked by composite anomaly' ELSE said END AS flag_reason,
         (rank() OVER (ORDER BY priority_score) + (count(*) OVER (PARTITION BY priority_score) - 1) / 2e0) / count(*) OVER () AS score_percentile
  FROM scored
),
sev AS (
  SELECT *, CASE WHEN score_percentile >= 0.99 THEN 'Top 1%' WHEN score_percentile >= 0.95 THEN 'Top 5%' WHEN score_percentile >= 0.90 THEN 'Top 10%'
            WHEN flag_for_review THEN 'Flagged' ELSE 'Below threshold' END AS severity FROM ranked
)
"""
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, prelude: str = SQL):
    """Register a query and the SQL that checks it."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = prelude + sql
        return f

    return add


@query("j1_change_status_counts", "SELECT provider_id, technology, status, count(*) AS n, round(avg(signal_delta), 6) AS mean_delta FROM change GROUP BY ALL")
def _(spark, d):
    return change(spark, d).groupBy(*UNIT, "status").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("signal_delta"), 6).alias("mean_delta"))


@query("j1_full_outer_layers", "SELECT provider_id, technology, cell, signal_prior, signal_current, status FROM change")
def _(spark, d):
    layer = L.strongest(M.observations(spark, d), [*UNIT, "vintage", "cell"])
    of = lambda v: layer.where(F.col("vintage") == v)
    return H.layer_change(of("prior"), of("current"), [*UNIT, "cell"]).select(*UNIT, "cell", "signal_prior", "signal_current", "status")


@query("s14_layer_max_signal", "SELECT * FROM layer")
def _(spark, d):
    return L.strongest(M.observations(spark, d), [*UNIT, "vintage", "cell"])


@query("s13_shared_scan_fanout", """
SELECT l_suppkey % 4 AS provider_id, l_returnflag AS technology, l_linenumber AS down, l_partkey AS cell, max(l_quantity) AS signal
FROM lineitem WHERE l_suppkey % 4 IN (1, 3) AND ((l_returnflag = 'N' AND l_linenumber = 1) OR (l_returnflag = 'R' AND l_linenumber = 2)) GROUP BY ALL""", "")
def _(spark, d):
    li = M.table(spark, d, "lineitem").select((F.col("l_suppkey") % 4).alias("provider_id"), F.col("l_returnflag").alias("technology"), F.col("l_linenumber").alias("down"), F.col("l_partkey").alias("cell"), F.col("l_quantity").alias("signal"))
    kept = L.shared_scan(li, [1, 3], [("N", 1), ("R", 2)], "technology", "down")
    return kept.groupBy(*UNIT, "down", "cell").agg(F.max("signal").alias("signal"))


@query("a1_county_rollup", """SELECT provider_id, technology, county_geoid, state_fips, prior_hexes, current_hexes, new_hexes, lost_hexes, upgraded_hexes,
round(mean_signal_delta, 6) AS mean_signal_delta FROM rollup0""")
def _(spark, d):
    return county(spark, d).select(*UNIT, "county_geoid", "state_fips", "prior_hexes", "current_hexes", "new_hexes", "lost_hexes", "upgraded_hexes", *_r("mean_signal_delta"))


@query("a2_county_areas", """SELECT provider_id, technology, county_geoid, round(prior_km2, 6) AS prior_km2, round(current_km2, 6) AS current_km2, round(added_km2, 6) AS added_km2,
CASE WHEN isinf(pct_increase) THEN NULL ELSE round(pct_increase, 6) END AS pct_increase, isinf(pct_increase) AS from_nothing,
round(prior_cov_frac, 6) AS prior_cov_frac, round(current_cov_frac, 6) AS current_cov_frac, round(added_frac, 6) AS added_frac FROM cc""")
def _(spark, d):
    inf = F.col("pct_increase") == float("inf")
    pct = F.when(~inf, F.round("pct_increase", 6)).alias("pct_increase")
    return county(spark, d).select(*UNIT, "county_geoid", *_r("prior_km2", "current_km2", "added_km2"), pct, inf.alias("from_nothing"), *_r("prior_cov_frac", "current_cov_frac", "added_frac"))


@query("a3_combine_layers", """SELECT cell, max(signal_dbm) AS signal_dbm, arg_max(provider_id, (signal_dbm, provider_id, technology)) AS provider_id,
arg_max(technology, (signal_dbm, provider_id, technology)) AS technology FROM layer WHERE vintage = 'current' GROUP BY cell""")
def _(spark, d):
    obs = M.observations(spark, d).where("vintage = 'current'")
    layers = [L.strongest(obs.where(F.col("provider_id") == p), [*UNIT, "cell"]) for p in range(4)]
    return L.combined(layers, "cell", "signal_dbm", UNIT)


@query("j11_nearest_site_attribution", "SELECT provider_id, technology, cell, county_geoid, site_id, attribution FROM attr")
def _(spark, d):
    return attributed(spark, d).select(*UNIT, "cell", "county_geoid", "site_id", "attribution")


@query("a6_attribution_pivot", """SELECT provider_id, technology, county_geoid, round(added_new, 6) AS added_km2_new_site, round(added_exp, 6) AS added_km2_expanded_site,
round(added_un, 6) AS added_km2_unattributed, new_towers, new_in AS new_towers_in_county, new_towers - new_in AS new_towers_cross_border FROM att""")
def _(spark, d):
    rows = A.county_attribution(attributed(spark, d))
    return rows.select(*UNIT, "county_geoid", *_r("added_km2_new_site", "added_km2_expanded_site", "added_km2_unattributed"), "new_towers", "new_towers_in_county", "new_towers_cross_border")


@query("a7_no_sites", f"SELECT provider_id, technology, county_geoid, round(count(*) * {KM2}e0, 6) AS added_km2_unattributed, true AS inference_insufficient FROM gained GROUP BY ALL")
def _(spark, d):
    none = M.sites(spark, d).where(F.lit(False))
    rows = A.county_attribution(A.attribute_cells(change(spark, d), none))
    return rows.select(*UNIT, "county_geoid", *_r("added_km2_unattributed"), F.lit(True).alias("inference_insufficient"))


@query("a8_serving_sites", """SELECT provider_id, technology, county_geoid, count(DISTINCT site_id) AS serving,
count(DISTINCT CASE WHEN home = county_geoid THEN site_id END) AS serving_in_county FROM attr GROUP BY ALL""")
def _(spark, d):
    return A.serving_sites(attributed(spark, d))


@query("a9_site_counts", "SELECT provider_id, home, count(*) AS sites FROM site GROUP BY ALL")
def _(spark, d):
    return M.sites(spark, d).groupBy("provider_id", "home").agg(F.count(F.lit(1)).alias("sites"))


@query("a11_lobe_reach_p95", """SELECT provider_id, site_id, count(*) AS n, round(greatest(CASE WHEN count(*) >= 3 THEN quantile_cont(d, 0.95) ELSE 3000e0 END, 3000e0), 4) AS lobe_reach_m
FROM (SELECT provider_id, technology, cell, b.site_id AS site_id, b.d AS d FROM near WHERE b.d <= b.reach) GROUP BY ALL""")
def _(spark, d):
    from ..operators.spatial import nearest

    gained = change(spark, d).where(F.col("status").isin("new", "upgraded"))
    near = nearest(gained, M.sites(spark, d).select("provider_id", "x_m", "y_m", "site_id", "reach_m"), 6000.0, ["provider_id"], [*UNIT, "cell"], "site_id").where("dist_m <= reach_m")
    p95 = F.percentile("dist_m", 0.95)
    n = F.count(F.lit(1))
    return near.groupBy("provider_id", "site_id").agg(n.alias("n"), F.round(F.greatest(F.when(n >= C.MIN_TESTS, p95).otherwise(3000.0), F.lit(C.MIN_REACH_M)), 4).alias("lobe_reach_m"))


@query("a12_hexes_per_site", "SELECT provider_id, site_id, count(*) AS n_hexes FROM attr WHERE site_id IS NOT NULL GROUP BY ALL")
def _(spark, d):
    return attributed(spark, d).where("site_id IS NOT NULL").groupBy("provider_id", "site_id").agg(F.count(F.lit(1)).alias("n_hexes"))


@query("t19_effective_reach", """SELECT site_id, round(CASE WHEN n_hexes % 3 > 0 THEN greatest(n_hexes % 3 * 2500e0, 3000e0) ELSE greatest(reach_m * 1.6e0, 3000e0) END, 6) AS reach FROM site""")
def _(spark, d):
    s = M.sites(spark, d)
    return s.select("site_id", F.round(A.effective_reach(F.col("n_hexes") % 3 * F.lit(2500.0), F.col("reach_m")), 6).alias("reach"))


@query("a10_boundary_share", "SELECT provider_id, technology, county_geoid, round(boundary_snap_share, 6) AS boundary_snap_share FROM bnd")
def _(spark, d):
    return boundary(spark, d).select(*UNIT, "county_geoid", *_r("boundary_snap_share"))


_F = ["added_frac_of_county", "coverage_increase_magnitude", "blanket_fillin", "same_site_growth_share", "unattributed_share", "boundary_snap_share", "new_site_share", "signal_jump_implausibility"]


@query("c1_features", "SELECT provider_id, technology, county_geoid, " + ", ".join(f"round({n}, 6) AS {n}" for n in _F) + ", new_towers, new_towers_cross_border FROM feat")
def _(spark, d):
    return feats(spark, d).select(*UNIT, "county_geoid", *_r(*_F), "new_towers", "new_towers_cross_border")


@query("c2_score_contributions", """SELECT provider_id, technology, county_geoid, round(c1, 6) AS added_frac, round(c2, 6) AS magnitude, round(c3, 6) AS blanket, round(c4, 6) AS same_site,
round(c6, 6) AS boundary, round(c7, 6) AS new_site, round(priority_score, 6) AS priority_score FROM scored""")
def _(spark, d):
    part = lambda n, to: F.round(f"score_contribution_{n}", 6).alias(to)
    return scored(spark, d).select(*UNIT, "county_geoid", part("added_frac_of_county", "added_frac"), part("coverage_increase_magnitude", "magnitude"), part("blanket_fillin", "blanket"), part("same_site_growth_share", "same_site"), part("boundary_snap_share", "boundary"), part("new_site_share", "new_site"), *_r("priority_score"))


@query("p7_flags", "SELECT provider_id, technology, county_geoid, flag_for_review FROM scored")
def _(spark, d):
    return scored(spark, d).select(*UNIT, "county_geoid", "flag_for_review")


@query("f_flag_reason", "SELECT provider_id, technology, county_geoid, flag_reason FROM ranked")
def _(spark, d):
    return scored(spark, d).select(*UNIT, "county_geoid", "flag_reason")


@query("w1_severity", "SELECT provider_id, technology, county_geoid, round(score_percentile, 6) AS score_percentile, severity FROM sev")
def _(spark, d):
    return S.severity(scored(spark, d)).select(*UNIT, "county_geoid", *_r("score_percentile"), "severity")


@query("w3_tiers", """SELECT provider_id, technology, county_geoid, CASE WHEN n <= 50 THEN 'red' WHEN n <= 100 THEN 'orange' WHEN n <= 150 THEN 'yellow' WHEN n <= 250 THEN 'green' END AS tier
FROM (SELECT *, row_number() OVER (PARTITION BY provider_id, technology ORDER BY priority_score DESC, added_km2 DESC NULLS LAST, county_geoid) AS n FROM scored)""")
def _(spark, d):
    return scored(spark, d).select(*UNIT, "county_geoid", S.tier().alias("tier"))


@query("ranking", """SELECT row_number() OVER (ORDER BY round(priority_score, 9) DESC, provider_id, technology, county_geoid) AS rank, provider_id, technology, county_geoid,
round(added_km2, 6) AS added_km2, round(priority_score, 6) AS priority_score, flag_for_review, severity, flag_reason FROM sev""")
def _(spark, d):
    # One row a unit and county remains; the global order is over those.
    place = F.row_number().over(W.orderBy(*in_order())).cast("bigint").alias("rank")
    return S.severity(scored(spark, d)).select(place, *UNIT, "county_geoid", *_r("added_km2", "priority_score"), "flag_for_review", "severity", "flag_reason")


@query("k6_selection", """SELECT row_number() OVER (ORDER BY round(priority_score, 9) DESC, provider_id, technology, county_geoid) AS select_rank, provider_id, technology, county_geoid,
round(priority_score, 6) AS priority_score FROM scored WHERE flag_for_review""")
def _(spark, d):
    place = F.row_number().over(W.orderBy(*in_order())).cast("bigint").alias("select_rank")
    return scored(spark, d).where("flag_for_review").select(place, *UNIT, "county_geoid", *_r("priority_score"))


@query("k4_coverage_trim", """SELECT l.* FROM layer l JOIN cells USING (cell) WHERE county_geoid IN (
SELECT county_geoid FROM (SELECT *, row_number() OVER (PARTITION BY provider_id, technology ORDER BY round(priority_score, 9) DESC, county_geoid) AS n FROM scored) WHERE n <= 2 OR flag_for_review)""")
def _(spark, d):
    s = scored(spark, d).select(*UNIT, "county_geoid", "priority_score", "flag_for_review")
    n = F.row_number().over(W.partitionBy(*UNIT).orderBy(F.desc(F.round("priority_score", 9)), "county_geoid"))
    keep = s.withColumn("n", n).where("n <= 2 OR flag_for_review").select("county_geoid")
    layer = M.with_geo(L.strongest(M.observations(spark, d), [*UNIT, "vintage", "cell"]), "county_geoid")
    return layer.join(keep, "county_geoid", "left_semi").select(*UNIT, "vintage", "cell", "signal_dbm")


@query("k10_web_meta", """SELECT provider_id, string_agg(DISTINCT technology, ',' ORDER BY technology) AS services, count(*) AS records, count(*) FILTER (WHERE flag_for_review) AS flagged FROM scored GROUP BY ALL""")
def _(spark, d):
    return scored(spark, d).groupBy("provider_id").agg(F.array_join(F.sort_array(F.collect_set("technology")), ",").alias("services"), F.count(F.lit(1)).alias("records"), F.count_if("flag_for_review").alias("flagged"))


@query("a34_run_stats", "SELECT count(*) AS row_count, count(*) FILTER (WHERE flag_for_review) AS flagged, count(DISTINCT provider_id) AS providers FROM scored")
def _(spark, d):
    return scored(spark, d).agg(F.count(F.lit(1)).alias("row_count"), F.count_if("flag_for_review").alias("flagged"), F.count_distinct("provider_id").alias("providers"))


@query("a33_national_threshold", "SELECT CASE WHEN count(*) <= 1 THEN 0e0 ELSE round(quantile_cont(priority_score, 0.95), 6) END AS threshold FROM scored")
def _(spark, d):
    return scored(spark, d).agg(F.when(F.count(F.lit(1)) <= 1, 0.0).otherwise(F.round(F.percentile("priority_score", 0.95), 6)).alias("threshold"))


@query("a26_implied_radius", """SELECT count(*) AS n, round(quantile_cont(r, 0.5), 6) AS p50, round(quantile_cont(r, 0.9), 6) AS p90, round(quantile_cont(r, 0.99), 6) AS p99
FROM (SELECT sqrt(added_exp / pi()) AS r FROM att WHERE added_exp > 0)""")
def _(spark, d):
    a = A.county_attribution(attributed(spark, d)).where("added_km2_expanded_site > 0")
    r = F.sqrt(F.col("added_km2_expanded_site") / F.pi())
    p = lambda q, n: F.round(F.percentile(r, q), 6).alias(n)
    return a.agg(F.count(F.lit(1)).alias("n"), p(0.5, "p50"), p(0.9, "p90"), p(0.99, "p99"))


@query("l5_preferred_provider", "SELECT technology, arg_max(provider_id, (f, -provider_id)) AS provider_id, max(f) AS flagged FROM (SELECT technology, provider_id, count(*) FILTER (WHERE flag_for_review) AS f FROM scored GROUP BY ALL) GROUP BY technology")
def _(spark, d):
    f = scored(spark, d).groupBy("technology", "provider_id").agg(F.count_if("flag_for_review").alias("f"))
    return f.groupBy("technology").agg(F.max_by("provider_id", F.struct("f", -F.col("provider_id"))).alias("provider_id"), F.max("f").alias("flagged"))


@query("k9_web_records", "SELECT provider_id, technology, county_geoid, '{\"added_km2\":' || CAST(CAST(round(added_km2 * 1000) AS BIGINT) AS VARCHAR) || ',\"flagged\":' || CAST(flag_for_review AS VARCHAR) || '}' AS record FROM scored")
def _(spark, d):
    m = F.to_json(F.struct(F.round(F.col("added_km2") * 1000).cast("bigint").alias("added_km2"), F.col("flag_for_review").alias("flagged")))
    return scored(spark, d).select(*UNIT, "county_geoid", m.alias("record"))


# --- sites -------------------------------------------------------------------

_CORE_SQL = SQL + """
, cur AS (SELECT provider_id, technology, cell, signal_dbm AS s FROM layer WHERE vintage = 'current'),
band AS (SELECT provider_id, technology, s, count(*) AS n FROM cur GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER w / CAST(sum(n) OVER (PARTITION BY provider_id, technology) AS DOUBLE) AS share,
        (sum(n) OVER w - n) / CAST(sum(n) OVER (PARTITION BY provider_id, technology) AS DOUBLE) AS before
        FROM band WINDOW w AS (PARTITION BY provider_id, technology ORDER BY s DESC)),
core AS (SELECT provider_id, technology, min(s) AS threshold FROM cum WHERE before < 0.35 AND NOT (share > 0.60 AND before >= 0.18) GROUP BY ALL)
"""


def core_threshold(spark: SparkSession, d: str) -> DataFrame:
    """Per unit the lowest signal band of the core: bands from the strongest on, until a share of 35 % is reached."""
    layer = L.strongest(M.observations(spark, d).where("vintage = 'current'"), [*UNIT, "cell"])
    band = layer.groupBy(*UNIT, "signal_dbm").agg(F.count(F.lit(1)).alias("n"))
    down = W.partitionBy(*UNIT).orderBy(F.desc("signal_dbm"))
    total = F.sum("n").over(W.partitionBy(*UNIT))
    cum = band.withColumn("share", F.sum("n").over(down) / total).withColumn("before", (F.sum("n").over(down) - F.col("n")) / total)
    kept = (F.col("before") < C.CORE_TARGET) & ~((F.col("share") > C.CORE_HIGH) & (F.col("before") >= C.CORE_LOW))
    return cum.where(kept).groupBy(*UNIT).agg(F.min("signal_dbm").alias("threshold"))


def core(spark: SparkSession, d: str) -> DataFrame:
    layer = L.strongest(M.observations(spark, d).where("vintage = 'current'"), [*UNIT, "cell"])
    return layer.join(core_threshold(spark, d), UNIT).where("signal_dbm >= threshold").drop("threshold")


@query("a27_core_threshold", "SELECT * FROM core", _CORE_SQL)
def _(spark, d):
    return core_threshold(spark, d)


@query("t1_core_cells", "SELECT provider_id, technology, cell, s AS signal_dbm FROM cur JOIN core USING (provider_id, technology) WHERE s >= threshold", _CORE_SQL)
def _(spark, d):
    return core(spark, d)


def _edges(cells: DataFrame) -> DataFrame:
    """(provider_id, technology, cell, other): adjacent cells of a unit, both ways."""
    steps = F.array(*[F.struct(F.lit(a).alias("dq"), F.lit(b).alias("dr")) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1))])
    q, r = F.col("cell") % 50 + F.col("s.dq"), F.floor(F.col("cell") / 50) + F.col("s.dr")
    out = cells.select(*UNIT, "cell", F.explode(steps).alias("s")).where((q >= 0) & (q < 50) & (r >= 0)).select(*UNIT, "cell", (r * 50 + q).alias("other"))
    return out.join(cells.select(*UNIT, F.col("cell").alias("other")), [*UNIT, "other"])


def _unit_cells(spark: SparkSession, d: str) -> DataFrame:
    layer = L.strongest(M.observations(spark, d).where("vintage = 'current'"), [*UNIT, "cell"])
    return layer.where("signal_dbm >= -75")


#: Rows of cells in a strip whose blobs one kernel call finds.
STRIP = 256


def _local(cells: DataFrame) -> DataFrame:
    """Least cell of each cell's blob within its strip of a unit."""
    from ..operators.inference import Grid

    def kernel(df):
        df = df.sort_values("cell")
        cell = df.cell.to_numpy()
        label = cell[Grid(cell % 50, cell // 50).blobs(np.ones(len(cell), bool))]
        return df[[*UNIT, "cell"]].assign(label=label)

    strip = F.floor(F.col("cell") / (50 * STRIP)).alias("strip")
    return cells.select(*UNIT, "cell").groupBy(*UNIT, strip).applyInPandas(kernel, "provider_id int, technology string, cell long, label long")


def components(cells: DataFrame) -> DataFrame:
    """Least cell of the connected blob of each cell: blobs of strips by a kernel, then these joined where strips meet.

    The parts of a blob are joined by label propagation with pointer jumping over the
    few that touch a strip's end. Each round takes the least label around and then that label's own label, so
    rounds grow with the logarithm of the strips that a blob crosses. Lineage is cut by checkpoint() every round.
    """
    spark = cells.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hexdrift-"))
    part = _local(cells).checkpoint()
    row = F.floor(F.col("cell") / 50) % STRIP
    ends = part.where((row == 0) | (row == STRIP - 1))
    across = _edges(ends.select(*UNIT, "cell")).where(F.floor(F.col("cell") / (50 * STRIP)) != F.floor(F.col("other") / (50 * STRIP)))
    named = across.join(ends.select(*UNIT, "cell", F.col("label").alias("a")), [*UNIT, "cell"]).join(ends.select(*UNIT, F.col("cell").alias("other"), F.col("label").alias("b")), [*UNIT, "other"])
    edges = named.select(*UNIT, F.col("a").alias("cell"), F.col("b").alias("other")).distinct().checkpoint()
    joined = _propagated(edges.select(*UNIT, "cell").distinct(), edges)
    found = joined.select(*UNIT, F.col("cell").alias("label"), F.col("label").alias("least"))
    return part.join(found, [*UNIT, "label"], "left").select(*UNIT, "cell", F.coalesce("least", "label").alias("label"))


def _propagated(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Least cell that each of ``nodes`` is joined to by ``edges``, which have both ways."""
    label = nodes.select(*UNIT, "cell", F.col("cell").alias("label")).checkpoint()
    while True:
        around = edges.join(label.withColumnRenamed("cell", "other"), [*UNIT, "other"]).groupBy(*UNIT, "cell").agg(F.min("label").alias("m"))
        low = label.join(around, [*UNIT, "cell"], "left").select(*UNIT, "cell", F.least("label", F.coalesce("m", "label")).alias("label"), F.col("label").alias("old"))
        jump = low.select(*UNIT, F.col("cell").alias("label"), F.col("label").alias("up"))
        new = low.join(jump, [*UNIT, "label"]).select(*UNIT, "cell", F.least("label", "up").alias("label"), "old").checkpoint()
        if new.where("label <> old").isEmpty():
            return new.drop("old")
        label = new.drop("old")


def depths(cells: DataFrame, most: int = 40) -> DataFrame:
    """Steps from the outside of each cell's blob, 1 at its edge, up to ``most``; a round for each step that any cell needs."""
    edges = _edges(cells).checkpoint()
    n = edges.groupBy(*UNIT, "cell").agg(F.count(F.lit(1)).alias("n"))
    known = cells.join(n, [*UNIT, "cell"], "left").select(*UNIT, "cell", F.when(F.coalesce("n", F.lit(0)) < 6, 1).alias("depth")).checkpoint()
    for depth in range(2, most + 1):
        reached = known.where(F.col("depth") == depth - 1).select(*UNIT, F.col("cell").alias("other"))
        nearby = edges.join(reached, [*UNIT, "other"]).select(*UNIT, "cell").distinct().withColumn("on", F.lit(True))
        new = known.join(nearby, [*UNIT, "cell"], "left").select(*UNIT, "cell", F.coalesce("depth", F.when(F.col("on"), depth)).alias("depth")).checkpoint()
        if new.where(F.col("depth") == depth).isEmpty():
            break
        known = new
    return known.where("depth IS NOT NULL")


_BLOB_SQL = SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """
, c AS (SELECT provider_id, technology, cell, signal_dbm, cell % 50 AS q, cell // 50 AS r FROM layer WHERE vintage = 'current' AND signal_dbm >= -75),
step AS (SELECT unnest([1, -1, 0, 0, 1, -1]) AS dq, unnest([0, 0, 1, -1, -1, 1]) AS dr),
e AS (SELECT a.provider_id, a.technology, a.cell, b.cell AS other, b.signal_dbm FROM (SELECT c.*, q + dq AS q2, r + dr AS r2 FROM c, step) a
  JOIN c b ON a.provider_id = b.provider_id AND a.technology = b.technology AND b.q = a.q2 AND b.r = a.r2),
walk AS (SELECT provider_id, technology, cell, cell AS label FROM c
  UNION SELECT e.provider_id, e.technology, e.other, walk.label FROM walk JOIN e USING (provider_id, technology, cell)),
deep AS (SELECT provider_id, technology, cell, 1 AS depth FROM c WHERE (SELECT count(*) FROM e WHERE e.provider_id = c.provider_id AND e.technology = c.technology AND e.cell = c.cell) < 6
  UNION SELECT e.provider_id, e.technology, e.other, deep.depth + 1 FROM deep JOIN e USING (provider_id, technology, cell) WHERE deep.depth < 40)
"""


@query("t3_components", "SELECT provider_id, technology, cell, min(label) AS label FROM walk GROUP BY ALL", _BLOB_SQL)
def _(spark, d):
    return components(_unit_cells(spark, d)).select(*UNIT, "cell", "label")


@query("t4_edge_cells", "SELECT provider_id, technology, cell, CAST(min(depth) AS INT) AS depth FROM deep GROUP BY ALL", _BLOB_SQL)
def _(spark, d):
    return depths(_unit_cells(spark, d)).select(*UNIT, "cell", "depth")


@query("t5_local_maxima", """SELECT c.provider_id, c.technology, c.cell FROM c LEFT JOIN e ON e.provider_id = c.provider_id AND e.technology = c.technology AND e.cell = c.cell
GROUP BY c.provider_id, c.technology, c.cell, c.signal_dbm HAVING coalesce(max(e.signal_dbm), -1e9) <= c.signal_dbm""", _BLOB_SQL)
def _(spark, d):
    cells = _unit_cells(spark, d)
    around = _edges(cells).join(cells.select(*UNIT, F.col("cell").alias("other"), F.col("signal_dbm").alias("s")), [*UNIT, "other"]).groupBy(*UNIT, "cell").agg(F.max("s").alias("s"))
    return cells.join(around, [*UNIT, "cell"], "left").where("s IS NULL OR s <= signal_dbm").select(*UNIT, "cell")


@query("g9_neighbor_smoothing", """SELECT c.provider_id, c.technology, c.cell, round((c.signal_dbm + coalesce(sum(e.signal_dbm), 0) * 0.5e0) / (1e0 + count(e.other) * 0.5e0), 6) AS smoothed
FROM c LEFT JOIN e ON e.provider_id = c.provider_id AND e.technology = c.technology AND e.cell = c.cell GROUP BY c.provider_id, c.technology, c.cell, c.signal_dbm""", _BLOB_SQL)
def _(spark, d):
    cells = _unit_cells(spark, d)
    near = _edges(cells).join(cells.select(*UNIT, F.col("cell").alias("other"), F.col("signal_dbm").alias("s")), [*UNIT, "other"]).groupBy(*UNIT, "cell").agg(F.sum("s").alias("s"), F.count(F.lit(1)).alias("n"))
    value = (F.col("signal_dbm") + F.coalesce("s", F.lit(0.0)) * 0.5) / (F.lit(1.0) + F.coalesce("n", F.lit(0)) * 0.5)
    return cells.join(near, [*UNIT, "cell"], "left").select(*UNIT, "cell", F.round(value, 6).alias("smoothed"))
