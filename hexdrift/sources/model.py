"""The logical tables of the coverage model over the driver's tables.

Cells are parts on an axial hexagon grid, observations are line items, sites are
suppliers, masts are customers, batches are orders, measurements are events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE_M = 532.725
ROOT3 = 3**0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _geo(cell: Column) -> dict[str, Column]:
    q, r = cell % 50, F.floor(cell / 50)
    county = F.floor(q / 10) + 5 * F.floor(r / 10)
    state = F.floor(county / 5)
    return {
        "q": q.cast("int"),
        "r": r.cast("int"),
        "x_m": F.lit(SIDE_M * ROOT3) * (q + r / F.lit(2.0)),
        "y_m": F.lit(SIDE_M * 1.5) * r,
        "county_id": county.cast("int"),
        "state_fips": F.lpad(state.cast("string"), 2, "0"),
        "county_geoid": F.concat(F.lpad(state.cast("string"), 2, "0"), F.lpad(county.cast("string"), 3, "0")),
    }


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell, q, r, x_m, y_m, county_id, state_fips, county_geoid."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cell"))
    return p.select("cell", *[c.alias(n) for n, c in _geo(F.col("cell")).items()])


def counties(spark: SparkSession, sf_dir: str, hex_km2: float) -> DataFrame:
    """county_geoid, state_fips, county_area_km2."""
    return cells(spark, sf_dir).groupBy("county_geoid", "state_fips").agg((F.count(F.lit(1)) * F.lit(hex_km2)).alias("county_area_km2"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """provider_id, technology, cell, signal_dbm, vintage; the cell's county follows from its key."""
    li = table(spark, sf_dir, "lineitem")
    cell = F.col("l_partkey")
    geo = _geo(cell)
    turn = F.lit(1996) + geo["county_id"] % 5
    return li.select(
        (F.col("l_suppkey") % 4).cast("int").alias("provider_id"),
        F.col("l_returnflag").alias("technology"),
        cell.alias("cell"),
        (F.lit(-120.0) + F.col("l_quantity")).alias("signal_dbm"),
        F.when(F.year("l_shipdate") < turn, "prior").otherwise("current").alias("vintage"),
    )


def with_geo(df: DataFrame, *names: str) -> DataFrame:
    """Columns of the cell's place, by formula rather than by join."""
    geo = _geo(F.col("cell"))
    return df.select("*", *[geo[n].alias(n) for n in names])


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """provider_id, site_id, x_m, y_m, site_class, reach_m, n_hexes, home (county)."""
    top = table(spark, sf_dir, "part").agg(F.max("p_partkey").alias("top")).first()["top"]
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    s = s.select(
        (key % 4).cast("int").alias("provider_id"),
        key.alias("site_id"),
        ((key * 7919) % (top + 1)).alias("cell"),
        F.element_at(F.array(F.lit("new_site"), F.lit("expanded_site"), F.lit("stable_site")), (key % 3 + 1).cast("int")).alias("site_class"),
        (F.lit(3000.0) + F.lit(500.0) * (key % 7)).alias("reach_m"),
        (F.lit(1) + key % 90).cast("int").alias("n_hexes"),
    )
    return with_geo(s, "x_m", "y_m", "county_geoid").withColumnRenamed("county_geoid", "home").drop("cell")


def masts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mast_id, x_m, y_m, county_geoid, event_date (first order, null without any)."""
    top = table(spark, sf_dir, "part").agg(F.max("p_partkey").alias("top")).first()["top"]
    key = F.col("c_custkey")
    c = table(spark, sf_dir, "customer")
    c = with_geo(c.select(key.alias("mast_id"), ((key * 7919) % (top + 1)).alias("cell"), F.col("c_acctbal").alias("off")), "x_m", "y_m", "county_geoid")
    first = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("mast_id")).agg(F.min("o_orderdate").cast("date").alias("event_date"))
    return c.join(first, "mast_id", "left").select("mast_id", (F.col("x_m") + F.col("off") / 10).alias("x_m"), "y_m", "county_geoid", "event_date")


#: The same tables in DuckDB's SQL, for the statements that check our results.
SQL = f"""
cells AS (
  SELECT cell, q, r, {SIDE_M * ROOT3}::DOUBLE * (q + r / 2.0::DOUBLE) AS x_m, {SIDE_M * 1.5}::DOUBLE * r AS y_m, county_id,
         lpad(CAST(county_id // 5 AS VARCHAR), 2, '0') AS state_fips,
         lpad(CAST(county_id // 5 AS VARCHAR), 2, '0') || lpad(CAST(county_id AS VARCHAR), 3, '0') AS county_geoid
  FROM (SELECT cell, q, r, CAST((q // 10) + 5 * (r // 10) AS INT) AS county_id
        FROM (SELECT p_partkey AS cell, CAST(p_partkey % 50 AS INT) AS q, CAST(p_partkey // 50 AS INT) AS r FROM part))
),
county AS (SELECT county_geoid, state_fips, count(*) * 0.737327598e0 AS county_area_km2 FROM cells GROUP BY ALL),
obs AS (
  SELECT CAST(l_suppkey % 4 AS INT) AS provider_id, l_returnflag AS technology, cell, -120e0 + l_quantity AS signal_dbm,
         CASE WHEN year(l_shipdate) < 1996 + county_id % 5 THEN 'prior' ELSE 'current' END AS vintage
  FROM lineitem JOIN cells ON l_partkey = cell
),
layer AS (SELECT provider_id, technology, vintage, cell, max(signal_dbm) AS signal_dbm FROM obs GROUP BY ALL),
change0 AS (
  SELECT coalesce(p.provider_id, c.provider_id) AS provider_id, coalesce(p.technology, c.technology) AS technology,
         coalesce(p.cell, c.cell) AS cell, p.signal_dbm AS signal_prior, c.signal_dbm AS signal_current
  FROM (SELECT * FROM layer WHERE vintage = 'prior') p FULL JOIN (SELECT * FROM layer WHERE vintage = 'current') c
    ON p.provider_id = c.provider_id AND p.technology = c.technology AND p.cell = c.cell
),
change AS (
  SELECT h.*, county_geoid, state_fips, x_m, y_m, q, r,
         CASE WHEN signal_prior IS NULL THEN 'new' WHEN signal_current IS NULL THEN 'lost'
              WHEN signal_current - signal_prior >= 5 THEN 'upgraded' WHEN signal_current - signal_prior <= -5 THEN 'downgraded'
              ELSE 'unchanged' END AS status,
         coalesce(signal_current - signal_prior, 0e0) AS signal_delta
  FROM change0 h JOIN cells USING (cell)
),
rollup0 AS (
  SELECT provider_id, technology, county_geoid, state_fips, count(signal_prior) AS prior_hexes, count(signal_current) AS current_hexes,
         count(*) FILTER (WHERE status = 'new') AS new_hexes, count(*) FILTER (WHERE status = 'lost') AS lost_hexes,
         count(*) FILTER (WHERE status = 'upgraded') AS upgraded_hexes, avg(signal_delta) AS mean_signal_delta
  FROM change GROUP BY ALL
),
cc AS (
  SELECT r.*, prior_hexes * 0.737327598e0 AS prior_km2, current_hexes * 0.737327598e0 AS current_km2,
         (current_hexes - prior_hexes) * 0.737327598e0 AS added_km2,
         CASE WHEN prior_hexes > 0 THEN (current_hexes - prior_hexes) / CAST(prior_hexes AS DOUBLE)
              WHEN current_hexes > 0 THEN CAST('Infinity' AS DOUBLE) ELSE 0e0 END AS pct_increase,
         county_area_km2, prior_hexes * 0.737327598e0 / county_area_km2 AS prior_cov_frac,
         current_hexes * 0.737327598e0 / county_area_km2 AS current_cov_frac,
         (current_hexes - prior_hexes) * 0.737327598e0 / county_area_km2 AS added_frac
  FROM rollup0 r JOIN county USING (county_geoid, state_fips)
),
top AS (SELECT max(p_partkey) AS top FROM part),
site AS (
  SELECT CAST(s_suppkey % 4 AS INT) AS provider_id, s_suppkey AS site_id,
         {SIDE_M * ROOT3}::DOUBLE * (c % 50 + (c // 50) / 2.0::DOUBLE) AS x_m, {SIDE_M * 1.5}::DOUBLE * (c // 50) AS y_m,
         CASE s_suppkey % 3 WHEN 0 THEN 'new_site' WHEN 1 THEN 'expanded_site' ELSE 'stable_site' END AS site_class,
         3000e0 + 500 * (s_suppkey % 7) AS reach_m, CAST(1 + s_suppkey % 90 AS INT) AS n_hexes,
         lpad(CAST(k // 5 AS VARCHAR), 2, '0') || lpad(CAST(k AS VARCHAR), 3, '0') AS home
  FROM (SELECT *, (c % 50) // 10 + 5 * ((c // 50) // 10) AS k FROM (SELECT *, (s_suppkey * 7919) % (top + 1) AS c FROM supplier, top))
),
mast AS (
  SELECT m.mast_id, x_m, y_m, county_geoid, event_date FROM (
    SELECT c_custkey AS mast_id, {SIDE_M * ROOT3}::DOUBLE * (c % 50 + (c // 50) / 2.0::DOUBLE) + c_acctbal / 10 AS x_m,
           {SIDE_M * 1.5}::DOUBLE * (c // 50) AS y_m,
           lpad(CAST(((c % 50) // 10 + 5 * ((c // 50) // 10)) // 5 AS VARCHAR), 2, '0')
             || lpad(CAST((c % 50) // 10 + 5 * ((c // 50) // 10) AS VARCHAR), 3, '0') AS county_geoid
    FROM (SELECT *, (c_custkey * 7919) % (top + 1) AS c FROM customer, top)) m
  LEFT JOIN (SELECT o_custkey AS mast_id, CAST(min(o_orderdate) AS DATE) AS event_date FROM orders GROUP BY 1) o ON m.mast_id = o.mast_id
)"""
