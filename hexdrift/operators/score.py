"""Risk features, the additive score, flags, severity, tiers and their explanation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as C
from .layers import UNIT


def _pos(c: Column) -> Column:
    return F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0))


def _unit(c: Column) -> Column:
    return F.least(_pos(c), F.lit(1.0))


def features(county: DataFrame, attribution: DataFrame, boundary: DataFrame | None = None) -> DataFrame:
    """One row a unit and county with all risk features."""
    key = [*UNIT, "county_geoid"]
    df = county.join(attribution, key, "left")
    df = df.join(boundary, key, "left") if boundary is not None else df.withColumn("boundary_snap_share", F.lit(0.0))
    kinds = {k: F.coalesce(F.col(f"added_km2_{k}"), F.lit(0.0)) for k in ("new_site", "expanded_site", "unattributed")}
    total = F.greatest(kinds["new_site"] + kinds["expanded_site"] + kinds["unattributed"], F.lit(C.EPS))
    added = _pos(F.col("added_frac"))
    jump = _pos(F.col("pct_increase"))
    squashed = F.when(jump == float("inf"), F.lit(1.0)).otherwise(jump / (jump + 1))
    low, high = _unit(F.col("prior_cov_frac")), _unit(F.col("current_cov_frac"))
    count = lambda n: F.coalesce(F.col(n), F.lit(0)).cast("int").alias(n)
    return df.select(
        *key,
        "state_fips",
        "added_km2",
        "pct_increase",
        added.alias("added_frac_of_county"),
        (squashed * F.least(added / C.DAMP_REFERENCE, F.lit(1.0))).alias("coverage_increase_magnitude"),
        _unit(_pos(high - low) * (1 - low)).alias("blanket_fillin"),
        (kinds["expanded_site"] / total).alias("same_site_growth_share"),
        (kinds["unattributed"] / total).alias("unattributed_share"),
        F.coalesce("boundary_snap_share", F.lit(0.0)).alias("boundary_snap_share"),
        (kinds["new_site"] / total).alias("new_site_share"),
        _pos(F.col("mean_signal_delta")).alias("signal_jump_implausibility"),
        F.lit(0.0).alias("asr_no_new_structure"),
        count("new_towers"),
        count("new_towers_in_county"),
        count("new_towers_cross_border"),
    )


def contributions(weights: dict[str, float] | None = None) -> dict[str, Column]:
    """Share of each feature in the score, in the order in which they are summed."""
    weights = C.WEIGHTS if weights is None else weights
    if heavy := [n for n, w in weights.items() if abs(w) > C.MAX_INFLUENCE]:
        raise ValueError(f"weights above {C.MAX_INFLUENCE}: {', '.join(heavy)}")
    whole = max(sum(map(abs, weights.values())), 1.0)
    out = {}
    for name, w in weights.items():
        x = F.least(F.greatest(F.coalesce(F.col(name), F.lit(0.0)) / C.RANGES.get(name, 1.0), F.lit(0.0)), F.lit(1.0))
        out[name] = (F.lit(w) * x if w >= 0 else F.lit(-w) * (1 - x)) / F.lit(whole)
    return out


def flag() -> Column:
    """Enough area, mostly grown from known sites, implausibly so, and not explained by new ones."""
    x = lambda n: F.coalesce(F.col(n), F.lit(0.0))
    implausible = (x("added_frac_of_county") >= C.COUNTY_FRACTION) | (x("blanket_fillin") >= C.BLANKET) | (x("unattributed_share") >= C.UNATTRIBUTED)
    built = (x("new_site_share") >= C.NEW_SHARE) & (F.col("new_towers") >= 1)
    across = (x("new_site_share") >= C.CROSS_SHARE) & (F.col("new_towers") >= 1) & (F.col("new_towers_cross_border") >= 1)
    return (x("added_km2") >= C.MIN_ADDED_KM2) & (x("same_site_growth_share") >= C.SAME_SITE) & implausible & ~built & ~across


def reason() -> Column:
    """Up to six conditional phrases."""
    percent = lambda n: F.format_string("%d%%", F.round(F.col(n) * 100).cast("int"))
    said = F.concat_ws(
        "; ",
        F.when(F.col("added_frac_of_county") >= 0.10, F.concat(F.lit("+"), percent("added_frac_of_county"), F.lit(" of county newly covered"))),
        F.when(F.col("blanket_fillin") >= 0.30, F.lit("rapid blanket fill-in from low baseline")),
        F.when(F.col("same_site_growth_share") >= C.SAME_SITE, F.concat(percent("same_site_growth_share"), F.lit(" of growth claimed from existing sites"))),
        F.when(F.col("unattributed_share") >= 0.3, F.concat(percent("unattributed_share"), F.lit(" of new coverage far from any inferred tower"))),
        F.when(F.col("boundary_snap_share") >= 0.4, F.concat(percent("boundary_snap_share"), F.lit(" of new coverage hugs county boundary"))),
        F.when(F.col("coverage_increase_magnitude") >= 1.0, F.when(F.col("pct_increase") == float("inf"), F.lit("coverage in previously-uncovered area")).otherwise(F.concat(F.lit("coverage up "), percent("pct_increase")))),
    )
    return F.when(said == "", F.lit("ranked by composite anomaly")).otherwise(said)


def scored(feats: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Contributions, priority_score, flag_for_review and flag_reason."""
    parts = contributions(weights)
    df = feats.select("*", *[c.alias(f"score_contribution_{n}") for n, c in parts.items()])
    total = F.lit(0.0)
    for n in parts:
        total = total + F.col(f"score_contribution_{n}")
    return df.withColumn("priority_score", total).withColumn("flag_for_review", flag()).withColumn("flag_reason", reason())


def severity(df: DataFrame) -> DataFrame:
    """Average-rank percentile of the score over all rows, and a label.

    Ranks are counted over distinct scores, so the one global window sees one
    row a score instead of one a row.
    """
    ties = df.groupBy("priority_score").agg(F.count(F.lit(1)).alias("_n"))
    up_to = F.sum("_n").over(W.orderBy("priority_score"))
    every = F.sum("_n").over(W.partitionBy())
    ranks = ties.select("priority_score", ((up_to - (F.col("_n") - 1) / F.lit(2.0)) / every).alias("score_percentile"))
    label = None
    for least, name in C.SEVERITY:
        at = F.col("score_percentile") >= least
        label = F.when(at, name) if label is None else label.when(at, name)
    label = label.when(F.col("flag_for_review"), "Flagged").otherwise("Below threshold")
    return df.join(ranks, "priority_score").withColumn("severity", label)


def tier() -> Column:
    """Colour of a row by its place within its unit; null beyond the last."""
    place = F.row_number().over(W.partitionBy(*UNIT).orderBy(F.desc("priority_score"), F.desc_nulls_last("added_km2"), "county_geoid"))
    out = None
    for last, name in C.TIERS:
        out = F.when(place <= last, name) if out is None else out.when(place <= last, name)
    return out
