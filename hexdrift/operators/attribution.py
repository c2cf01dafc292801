"""Growth of coverage attributed to inferred sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ATTRIBUTION_MARGIN, HEX_KM2, MIN_REACH_M
from .layers import UNIT
from .spatial import nearest


def effective_reach(lobe: Column, core: Column) -> Column:
    """How far a site is taken to serve: its lobe if known, else its core and a margin."""
    floor = F.lit(MIN_REACH_M)
    return F.when(lobe > 0, F.greatest(lobe, floor)).otherwise(F.greatest(core * ATTRIBUTION_MARGIN, floor))


def attribute_cells(change: DataFrame, sites: DataFrame) -> DataFrame:
    """Gained cells with the nearest site of their provider; only that one's reach is tested.

    A nearest site beyond every reach cannot be within its own, so the search
    stops at the largest reach.
    """
    gained = change.where(F.col("status").isin("new", "upgraded") & F.col("county_geoid").isNotNull())
    widest = sites.agg(F.max("reach_m")).first()[0] or 1.0
    key = [*UNIT, "cell"]
    found = nearest(gained, sites.select("provider_id", "x_m", "y_m", "site_id", "site_class", "reach_m", "home"), float(widest), ["provider_id"], key, "site_id")
    out = gained.select(*key, "county_geoid").join(found, key, "left")
    hit = F.coalesce(F.col("dist_m") <= F.col("reach_m"), F.lit(False))
    return out.select(
        *key,
        "county_geoid",
        F.when(hit, F.col("site_id")).alias("site_id"),
        F.when(hit, F.col("site_class")).otherwise("unattributed").alias("attribution"),
        F.when(hit, F.col("home")).alias("home"),
    )


def county_attribution(attributed: DataFrame, resolution: int = 8) -> DataFrame:
    """Added area by kind of site and the number of new sites, in a single aggregation."""
    km2 = F.lit(HEX_KM2[resolution])
    kind = lambda s: (F.count_if(F.col("attribution") == s) * km2).alias(f"added_km2_{s}")
    new = F.when(F.col("attribution") == "new_site", F.col("site_id"))
    inside = F.when((F.col("attribution") == "new_site") & (F.col("home") == F.col("county_geoid")), F.col("site_id"))
    rows = attributed.groupBy(*UNIT, "county_geoid").agg(
        kind("new_site"), kind("expanded_site"), kind("unattributed"), F.count_distinct(new).alias("new_towers"), F.count_distinct(inside).alias("new_towers_in_county")
    )
    return rows.withColumn("new_towers_cross_border", F.col("new_towers") - F.col("new_towers_in_county"))


def serving_sites(attributed: DataFrame) -> DataFrame:
    """Distinct sites serving each unit and county, and how many are at home there; zero where none."""
    home = F.when(F.col("home") == F.col("county_geoid"), F.col("site_id"))
    return attributed.groupBy(*UNIT, "county_geoid").agg(F.count_distinct("site_id").alias("serving"), F.count_distinct(home).alias("serving_in_county"))
