"""The difference of two vintages, by cell and by county."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HEX_KM2, STEP_DB
from .layers import UNIT


def _status(df: DataFrame) -> DataFrame:
    delta = F.col("signal_current") - F.col("signal_prior")
    status = (
        F.when(F.col("signal_prior").isNull(), "new")
        .when(F.col("signal_current").isNull(), "lost")
        .when(delta >= STEP_DB, "upgraded")
        .when(delta <= -STEP_DB, "downgraded")
        .otherwise("unchanged")
    )
    return df.withColumn("status", status).withColumn("signal_delta", F.coalesce(delta, F.lit(0.0)))


def layer_change(prior: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two layers that have one row a key."""
    p = prior.select(*keys, F.col("signal_dbm").alias("signal_prior"))
    c = current.select(*keys, F.col("signal_dbm").alias("signal_current"))
    return _status(p.join(c, keys, "full_outer"))


def observed_change(obs: DataFrame, keys: list[str]) -> DataFrame:
    """The same from raw observations of both vintages: one aggregation instead of two and a join."""
    of = lambda v: F.max(F.when(F.col("vintage") == v, F.col("signal_dbm")))
    return _status(obs.groupBy(*keys).agg(of("prior").alias("signal_prior"), of("current").alias("signal_current")))


def county_change(change: DataFrame, counties: DataFrame, resolution: int = 8) -> DataFrame:
    """Counts, areas and shares of each unit and county."""
    km2 = F.lit(HEX_KM2[resolution])
    n = lambda s: F.count_if(F.col("status") == s)
    rows = change.where(F.col("county_geoid").isNotNull()).groupBy(*UNIT, "county_geoid").agg(
        F.count("signal_prior").alias("prior_hexes"),
        F.count("signal_current").alias("current_hexes"),
        n("new").alias("new_hexes"),
        n("lost").alias("lost_hexes"),
        n("upgraded").alias("upgraded_hexes"),
        F.avg("signal_delta").alias("mean_signal_delta"),
    )
    more = F.col("current_hexes") - F.col("prior_hexes")
    area = F.when(F.col("county_area_km2") > 0, F.col("county_area_km2"))
    pct = (
        F.when(F.col("prior_hexes") > 0, more / F.col("prior_hexes").cast("double"))
        .when(F.col("current_hexes") > 0, F.lit(float("inf")))
        .otherwise(F.lit(0.0))
    )
    return rows.join(counties, "county_geoid", "left").select(
        *rows.columns,
        "state_fips",
        (F.col("prior_hexes") * km2).alias("prior_km2"),
        (F.col("current_hexes") * km2).alias("current_km2"),
        (more * km2).alias("added_km2"),
        pct.alias("pct_increase"),
        "county_area_km2",
        (F.col("prior_hexes") * km2 / area).alias("prior_cov_frac"),
        (F.col("current_hexes") * km2 / area).alias("current_cov_frac"),
        (more * km2 / area).alias("added_frac"),
    )
