"""Queries of geometry, kernels and the weight search."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from ..functions import geo as G
from ..operators import inference as I
from ..operators import kernels as K
from ..operators import layers as L
from ..operators import rings as R
from ..operators import score as S
from ..operators.spatial import near
from ..sources import model as M
from . import coverage, validation

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SQL = "WITH " + M.SQL + "\n"


def query(name: str, sql: str | None = None):
    """Register a query and the SQL that checks it."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


_LATLON = "SELECT s_suppkey, 25e0 + (s_suppkey * 37 % 240) / 10e0 AS lat, -120e0 + (s_suppkey * 53 % 500) / 10e0 AS lon FROM supplier"
_ALBERS = f"""WITH p AS ({_LATLON}), q AS (SELECT *, sin(radians(lat)) AS s FROM p),
r AS (SELECT *, {G.AXIS} * sqrt({G.C!r}::DOUBLE - {G.N!r}::DOUBLE * ({1 - G.ECC2!r}::DOUBLE * (s / (1 - {G.ECC2!r}::DOUBLE * s * s) - ln((1 - {G.ECC!r}::DOUBLE * s) / (1 + {G.ECC!r}::DOUBLE * s)) / {2 * G.ECC!r}::DOUBLE))) / {G.N!r}::DOUBLE AS rho,
  {G.N!r}::DOUBLE * (radians(lon) - {G.LON0!r}::DOUBLE) AS theta FROM q)
"""


def _latlon(spark, d):
    k = F.col("s_suppkey")
    return M.table(spark, d, "supplier").select("s_suppkey", (F.lit(25.0) + k * 37 % 240 / F.lit(10.0)).alias("lat"), (F.lit(-120.0) + k * 53 % 500 / F.lit(10.0)).alias("lon"))


@query("g2_albers_forward", _ALBERS + f"SELECT s_suppkey, round(rho * sin(theta), 3) AS x, round({G.RHO0!r}::DOUBLE - rho * cos(theta), 3) AS y FROM r")
def _(spark, d):
    x, y = G.albers(F.col("lat"), F.col("lon"))
    return _latlon(spark, d).select("s_suppkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("g2_albers_inverse", f"SELECT s_suppkey, round(lat, 5) AS lat, round(lon, 5) AS lon FROM ({_LATLON})")
def _(spark, d):
    x, y = G.albers(F.col("lat"), F.col("lon"))
    lat, lon = G.inverse_albers(F.col("x"), F.col("y"))
    return _latlon(spark, d).select("s_suppkey", x.alias("x"), y.alias("y")).select("s_suppkey", F.round(lat, 5).alias("lat"), F.round(lon, 5).alias("lon"))


_RING = f"""rings AS (SELECT county_geoid, q0, r0, [[-0.5, -0.5], [9.5, -0.5], [9.5, 9.5], [-0.5, 9.5]] AS o
  FROM (SELECT DISTINCT county_geoid, q // 10 * 10 AS q0, r // 10 * 10 AS r0 FROM cells)),
pts AS (SELECT county_geoid, i, {M.SIDE_M * M.ROOT3!r}::DOUBLE * (q0 + o[i][1] + (r0 + o[i][2]) / 2.0::DOUBLE) AS x, {M.SIDE_M * 1.5!r}::DOUBLE * (r0 + o[i][2]) AS y FROM rings, (SELECT unnest([1, 2, 3, 4]) AS i)),
edges AS (SELECT a.county_geoid, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS b_y FROM pts a JOIN pts b ON a.county_geoid = b.county_geoid AND b.i = a.i % 4 + 1)
"""


@query("g4_county_area_shoelace", SQL + ", " + _RING + "SELECT county_geoid, round(abs(sum(ax * b_y - bx * ay)) / 2 / 1e6, 6) AS km2 FROM edges GROUP BY county_geoid")
def _(spark, d):
    return R.areas(M.cells(spark, d)).select("county_geoid", F.round("km2", 6).alias("km2"))


_INSIDE = "count(*) FILTER (WHERE (ay > m.y_m) <> (b_y > m.y_m) AND m.x_m < (bx - ax) * (m.y_m - ay) / (b_y - ay) + ax)"


@query("j8_point_in_polygon", SQL + ", " + _RING + f"SELECT mast_id, county_geoid FROM (SELECT m.mast_id, e.county_geoid, {_INSIDE} AS n FROM mast m, edges e GROUP BY ALL) WHERE n % 2 = 1")
def _(spark, d):
    return R.inside(M.masts(spark, d), M.cells(spark, d))


@query("a10_edge_distance", SQL + ", " + _RING + """SELECT cell, round(min(sqrt(pow(x_m - ax - t * (bx - ax), 2) + pow(y_m - ay - t * (b_y - ay), 2))), 3) AS dist_m FROM (
SELECT c.cell, c.x_m, c.y_m, e.*, greatest(0e0, least(1e0, ((x_m - ax) * (bx - ax) + (y_m - ay) * (b_y - ay)) / ((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay)))) AS t FROM cells c JOIN edges e USING (county_geoid)) GROUP BY cell""")
def _(spark, d):
    return R.edge_distances(M.cells(spark, d))


@query("t8_sector_histogram", SQL + "SELECT CAST(floor((atan2(y_m - 20000, x_m - 20000) + pi()) / (2 * pi()) * 18) AS INT) % 18 AS bin, count(*) AS n FROM cells GROUP BY 1")
def _(spark, d):
    turn = (F.atan2(F.col("y_m") - 20000, F.col("x_m") - 20000) + F.pi()) / (2 * F.pi())
    return M.cells(spark, d).groupBy((F.floor(turn * 18).cast("int") % 18).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("t15_infer_sites")
def _(spark, d):
    return I.infer_sites(coverage.change(spark, d))


@query("t16_joint_classes")
def _(spark, d):
    """Inferred sites of both vintages with their kind; of those of the prior one alone, too."""
    sites = I.infer_sites(coverage.change(spark, d))
    return sites.select("provider_id", "technology", "site_id", "home", "n_prior", "n_current", I.site_class().alias("site_class"))


@query("t17_site_class", SQL + """SELECT provider_id, technology, county_geoid, CASE WHEN current_hexes <= 0 THEN 'prior_only' WHEN prior_hexes <= 2 THEN 'new_site'
WHEN (current_hexes - prior_hexes) / CAST(greatest(prior_hexes, 1) AS DOUBLE) >= 0.2 THEN 'expanded_site' ELSE 'stable_site' END AS site_class FROM rollup0""")
def _(spark, d):
    """The rules of the kind of a site, over what the two vintages have in each county."""
    c = coverage.county(spark, d).withColumnsRenamed({"prior_hexes": "n_prior", "current_hexes": "n_current"})
    return c.select("provider_id", "technology", "county_geoid", I.site_class().alias("site_class"))


@query("t21_lobe_census")
def _(spark, d):
    return I.infer_sites(coverage.change(spark, d)).groupBy("provider_id", "technology", "sectors").agg(F.count(F.lit(1)).alias("sites"))


@query("t2_flat_rollup", SQL + """, p AS (SELECT provider_id, technology, cell, signal_dbm, (3 * q + r) / 7e0 AS a, (2 * r - q) / 7e0 AS b FROM layer JOIN cells USING (cell) WHERE vintage = 'current'),
n AS (SELECT *, round(a) AS x, round(b) AS y, round(-a - b) AS z FROM p),
m AS (SELECT *, abs(x - a) AS dx, abs(y - b) AS dy, abs(z + a + b) AS dz FROM n)
SELECT provider_id, technology, CAST(CASE WHEN dx > dy AND dx > dz THEN -y - z ELSE x END AS INT) AS u, CAST(CASE WHEN NOT (dx > dy AND dx > dz) AND dy > dz THEN -x - z ELSE y END AS INT) AS v,
arg_max(cell, (signal_dbm, -cell)) AS seed, max(signal_dbm) AS signal_dbm, count(*) AS n FROM m GROUP BY ALL""")
def _(spark, d):
    return I.rolled_up(M.with_geo(L.strongest(M.observations(spark, d).where("vintage = 'current'"), [*L.UNIT, "cell"]), "q", "r"))


@query("t22_footprint_recall", SQL + """, covered AS (SELECT DISTINCT x_m, y_m FROM change WHERE signal_current IS NOT NULL),
inside AS (SELECT m.* FROM mast m WHERE EXISTS (SELECT 1 FROM covered c WHERE round(sqrt(pow(m.x_m - c.x_m, 2) + pow(m.y_m - c.y_m, 2)), 3) <= 2500)),
met AS (SELECT i.mast_id FROM inside i WHERE EXISTS (SELECT 1 FROM site s WHERE round(sqrt(pow(i.x_m - s.x_m, 2) + pow(i.y_m - s.y_m, 2)), 3) <= 2000))
SELECT (SELECT count(*) FROM inside) AS inside, (SELECT count(*) FROM met) AS met, CASE WHEN (SELECT count(*) FROM inside) > 0 THEN round((SELECT count(*) FROM met) / CAST((SELECT count(*) FROM inside) AS DOUBLE), 6) END AS recall""")
def _(spark, d):
    """Masts within 2.5 km of coverage, and how many of them have a site within 2 km."""
    masts = M.masts(spark, d).select("mast_id", "x_m", "y_m")
    cells = coverage.change(spark, d).where("signal_current IS NOT NULL").select("x_m", "y_m").distinct()
    inside = near(masts, cells, 2500.0, []).select("mast_id").distinct()
    met = near(masts, M.sites(spark, d).select("x_m", "y_m"), 2000.0, []).select("mast_id").distinct().withColumn("hit", F.lit(1))
    counts = inside.join(met, "mast_id", "left").agg(F.count(F.lit(1)).alias("inside"), F.count("hit").alias("met"))
    return counts.select("inside", "met", F.round(F.col("met") / F.nullif(F.col("inside"), F.lit(0)), 6).alias("recall"))


@query("j14_site_assignment")
def _(spark, d):
    s = M.sites(spark, d)
    moved = s.select("provider_id", F.col("site_id"), (F.col("x_m") + F.col("site_id") % 7 * 300.0).alias("x_m"), "y_m")
    return K.match_sites(moved, s, 2000.0)


@query("a19_bootstrap_interval")
def _(spark, d):
    return K.bootstrap(validation.rows(spark, d).select("flag", "label"))


@query("a25_feature_importance")
def _(spark, d):
    """Importances of a random forest that tells flagged rows from others."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    names = ["added_frac_of_county", "coverage_increase_magnitude", "blanket_fillin", "same_site_growth_share", "new_site_share", "boundary_snap_share"]
    rows = coverage.scored(spark, d).select(*names, F.col("flag_for_review").cast("double").alias("label"))
    data = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    model = RandomForestClassifier(numTrees=100, seed=42, maxDepth=5).fit(data)
    return spark.createDataFrame(list(zip(names, map(float, model.featureImportances.toArray()), strict=True)), "feature string, importance double")


_GRID = list(product((0.15, 0.25), (0.05, 0.10, 0.14), (0.10, 0.22), (5.0, 10.0, 20.0), (0.4, 0.5, 0.6)))


@query("a32_weight_grid_search", coverage.SQL + f"""
, cfg AS (SELECT * FROM (VALUES {", ".join(f"({i}, {a}e0, {b}e0, {c}e0, {m}e0, {s}e0)" for i, (a, b, c, m, s) in enumerate(_GRID))}) t(cfg, wa, wb, wc, least_km2, share))
SELECT cfg, count(*) FILTER (WHERE added_km2 >= least_km2 AND same_site_growth_share >= share AND s >= 0.2) AS flagged,
count(*) FILTER (WHERE added_km2 >= least_km2 AND same_site_growth_share >= share AND s >= 0.2 AND flag_for_review) AS agreed
FROM (SELECT *, wa * least(added_frac_of_county / 0.15e0, 1e0) + wb * blanket_fillin + wc * same_site_growth_share AS s FROM scored, cfg) GROUP BY cfg""")
def _(spark, d):
    """Every configuration against every row: the grid is a constant of 108 rows that each row is exploded into."""
    grid = F.array(*[F.struct(F.lit(i).alias("cfg"), *[F.lit(v).alias(n) for n, v in zip(("wa", "wb", "wc", "least_km2", "share"), g, strict=True)]) for i, g in enumerate(_GRID)])
    x = coverage.scored(spark, d).select("added_km2", "added_frac_of_county", "blanket_fillin", "same_site_growth_share", "flag_for_review", F.explode(grid).alias("g"))
    s = F.col("g.wa") * F.least(F.col("added_frac_of_county") / 0.15, F.lit(1.0)) + F.col("g.wb") * F.col("blanket_fillin") + F.col("g.wc") * F.col("same_site_growth_share")
    on = (F.col("added_km2") >= F.col("g.least_km2")) & (F.col("same_site_growth_share") >= F.col("g.share")) & (s >= 0.2)
    return x.groupBy(F.col("g.cfg").alias("cfg")).agg(F.count_if(on).alias("flagged"), F.count_if(on & F.col("flag_for_review")).alias("agreed"))


@query("c3_headline", coverage.SQL + """
SELECT provider_id, technology, county_geoid, CASE WHEN NOT flag_for_review AND added_km2 <= 0 THEN 'No added coverage'
WHEN flag_for_review AND blanket_fillin >= 0.3 THEN 'Rapid fill-in from existing sites' WHEN flag_for_review THEN 'Growth beyond what existing sites explain'
WHEN new_site_share >= 0.5 THEN 'Growth explained by new sites' ELSE 'Ordinary growth' END AS headline,
array_to_string(list_filter([CASE WHEN added_km2 >= 10 THEN 'area' END, CASE WHEN same_site_growth_share >= 0.5 THEN 'same sites' END,
CASE WHEN boundary_snap_share >= 0.4 THEN 'boundary' END, CASE WHEN new_towers > 0 THEN 'new sites' END, CASE WHEN unattributed_share >= 0.3 THEN 'unattributed' END], lambda x: x IS NOT NULL)[1:4], '; ') AS bullets FROM scored""")
def _(spark, d):
    on = F.col("flag_for_review")
    headline = (
        F.when(~on & (F.col("added_km2") <= 0), "No added coverage")
        .when(on & (F.col("blanket_fillin") >= 0.3), "Rapid fill-in from existing sites")
        .when(on, "Growth beyond what existing sites explain")
        .when(F.col("new_site_share") >= 0.5, "Growth explained by new sites")
        .otherwise("Ordinary growth")
    )
    rules = [("added_km2", 10, "area"), ("same_site_growth_share", 0.5, "same sites"), ("boundary_snap_share", 0.4, "boundary"), ("new_towers", 1, "new sites"), ("unattributed_share", 0.3, "unattributed")]
    said = F.array_compact(F.array(*[F.when(F.col(n) >= v, F.lit(t)) for n, v, t in rules]))
    return coverage.scored(spark, d).select("provider_id", "technology", "county_geoid", headline.alias("headline"), F.array_join(F.slice(said, 1, 4), "; ").alias("bullets"))


_POINTS = [("added_frac_of_county", "c1"), ("coverage_increase_magnitude", "c2"), ("blanket_fillin", "c3"), ("same_site_growth_share", "c4"), ("unattributed_share", "0e0"), ("boundary_snap_share", "c6"), ("new_site_share", "c7"), ("asr_no_new_structure", "0e0")]


@query("c4_flag_math", coverage.SQL + " UNION ALL ".join(f"SELECT provider_id, technology, county_geoid, '{n}' AS feature, round({'0e0' if n == 'asr_no_new_structure' else n}, 3) AS value, round({c}, 4) AS points FROM scored" for n, c in _POINTS))
def _(spark, d):
    """What each feature adds to the score, a row for each."""
    # SQL rounds the scaled double (0.0585 less one ulp becomes 58.5, then 59); F.round with digits rounds its decimal form.
    near = lambda c, scale: F.round(c.cast("double") * scale) / scale
    parts = F.array(*[F.struct(F.lit(n).alias("feature"), near(F.col(n), 1e3).alias("value"), near(F.col(f"score_contribution_{n}"), 1e4).alias("points")) for n in S.contributions()])
    return coverage.scored(spark, d).select("provider_id", "technology", "county_geoid", F.explode(parts).alias("p")).select("provider_id", "technology", "county_geoid", "p.*")


@query("k11_county_detail", coverage.SQL + """SELECT provider_id, technology, county_geoid, count(*) AS n, count(*) FILTER (WHERE status = 'new') AS new_cells,
string_agg(CAST(cell AS VARCHAR) || ':' || status, ',' ORDER BY cell) AS hexes FROM change JOIN (SELECT provider_id, technology, county_geoid FROM scored WHERE flag_for_review) USING (provider_id, technology, county_geoid) GROUP BY ALL""")
def _(spark, d):
    """Cells of every flagged county, in one text each, with their numbers."""
    flagged = coverage.scored(spark, d).where("flag_for_review").select("provider_id", "technology", "county_geoid")
    cells = coverage.change(spark, d).join(flagged, ["provider_id", "technology", "county_geoid"], "left_semi")
    named = F.transform(F.sort_array(F.collect_list(F.struct("cell", "status"))), lambda c: F.concat(c["cell"].cast("string"), F.lit(":"), c["status"]))
    return cells.groupBy("provider_id", "technology", "county_geoid").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "new").alias("new_cells"), F.array_join(named, ",").alias("hexes"))
