"""Joins by distance, as equi-joins on grid buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Euclidean distance in metres, to the millimetre so that ties on the grid are ties."""
    dx, dy = ax - bx, ay - by
    return F.round(F.sqrt(dx * dx + dy * dy), 3)


def near(left: DataFrame, right: DataFrame, radius: float, keys: list[str]) -> DataFrame:
    """Pairs of equal keys whose x_m, y_m lie within ``radius``: ``dist_m`` and the columns of both.

    Both sides fall into buckets of that size; each row of the right side, meant
    to be the smaller one, stands in nine of them. No pair farther than a bucket
    meets, so rows meet in proportion to their density.
    """
    bucket = lambda d: [F.floor(F.col("x_m") / radius).alias("_bx"), F.floor(F.col("y_m") / radius).alias("_by")]
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    own = [c for c in right.columns if c not in (*keys, "x_m", "y_m")]
    spread = (
        right.select(*keys, *own, F.col("x_m").alias("_x"), F.col("y_m").alias("_y"), *bucket(right), F.explode(around).alias("_o"))
        .withColumn("_bx", F.col("_bx") + F.col("_o.dx"))
        .withColumn("_by", F.col("_by") + F.col("_o.dy"))
        .drop("_o")
    )
    met = left.select("*", *bucket(left)).join(spread, [*keys, "_bx", "_by"])
    met = met.withColumn("dist_m", distance(F.col("x_m"), F.col("y_m"), F.col("_x"), F.col("_y")))
    return met.where(F.col("dist_m") <= radius).drop("_bx", "_by", "_x", "_y")


def close_pairs(points: DataFrame, radius: float) -> DataFrame:
    """Pairs a < b of ``id`` whose x_m, y_m are less than ``radius`` apart, each once.

    A point stands in its own bucket and in four around it, so two buckets meet from one side only.
    """
    at = points.select("id", "x_m", "y_m", F.floor(F.col("x_m") / radius).alias("_bx"), F.floor(F.col("y_m") / radius).alias("_by"))
    half = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1))])
    spread = at.select(F.col("id").alias("_id"), F.col("x_m").alias("_x"), F.col("y_m").alias("_y"), "_bx", "_by", F.explode(half).alias("_o"))
    own = (F.col("_o.dx") == 0) & (F.col("_o.dy") == 0)
    spread = spread.select("_id", "_x", "_y", (F.col("_bx") + F.col("_o.dx")).alias("_bx"), (F.col("_by") + F.col("_o.dy")).alias("_by"), own.alias("_own"))
    dx, dy = F.col("x_m") - F.col("_x"), F.col("y_m") - F.col("_y")
    # Not to the millimetre: a pair at 1,999.9997 m is closer than 2,000 m.
    met = at.join(spread, ["_bx", "_by"]).where(F.sqrt(dx * dx + dy * dy) < radius)
    once = (F.col("id") < F.col("_id")) | (~F.col("_own") & (F.col("id") > F.col("_id")))
    return met.where(once).select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b"))


def nearest(left: DataFrame, right: DataFrame, radius: float, keys: list[str], identity: list[str], right_id: str) -> DataFrame:
    """Per left row (``identity``) the nearest right row within ``radius``; least ``right_id`` on a tie."""
    own = [c for c in right.columns if c not in (*keys, "x_m", "y_m", right_id)]
    best = F.min(F.struct("dist_m", right_id, *own)).alias("b")
    found = near(left.select(*identity, *[k for k in keys if k not in identity], "x_m", "y_m"), right, radius, keys)
    return found.groupBy(*identity).agg(best).select(*identity, *[F.col(f"b.{c}").alias(c) for c in ["dist_m", right_id, *own]])
