"""Coverage layers: one signal per cell, the strongest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BAND_DBM

UNIT = ["provider_id", "technology"]


def signal(raw: Column) -> Column:
    """dBm of a raw value: band codes 1 to 3 have fixed levels, what is not a number is null."""
    number = F.nanvl(raw.try_cast("double"), F.lit(None).cast("double"))
    out = number
    for band, level in BAND_DBM.items():
        out = F.when(number == band, F.lit(level)).otherwise(out)
    return out


def strongest(df: DataFrame, keys: list[str], value: str = "signal_dbm") -> DataFrame:
    """One row a key with the strongest signal; what is not a number counts as 0."""
    return df.groupBy(*keys).agg(F.max(F.coalesce(F.col(value).try_cast("double"), F.lit(0.0))).alias(value))


def combined(layers: list[DataFrame], key: str, value: str, attributes: list[str]) -> DataFrame:
    """Union of layers: the strongest signal of a cell and the attributes that go with it."""
    every = layers[0]
    for x in layers[1:]:
        every = every.unionByName(x, allowMissingColumns=True)
    best = F.max(F.struct(F.col(value), *[F.col(a) for a in attributes])).alias("b")
    return every.groupBy(key).agg(best).select(key, *[F.col(f"b.{c}").alias(c) for c in [value, *attributes]])


def shared_scan(df: DataFrame, providers: list[int], pairs: list[tuple[str, int]], technology: str, down: str) -> DataFrame:
    """Rows of any listed provider and (technology, speed) pair: one filter that reaches the scan."""
    wanted = F.lit(False)
    for t, d in pairs:
        wanted = wanted | ((F.col(technology) == t) & (F.col(down) == d))
    return df.where(F.col("provider_id").isin(providers) & wanted)


def in_list(column: Column, value) -> Column:
    """Whether a comma-separated list has a member; null has none."""
    return F.array_contains(F.split(F.coalesce(column, F.lit("")), ","), str(value))


def parent(cell: Column, resolution: int) -> Column:
    """Parent of a 64-bit hexagon index: its resolution field set, lower digits filled with sevens."""
    low = (1 << 3 * (15 - resolution)) - 1
    return cell.bitwiseAND(F.lit(~(15 << 52))).bitwiseOR(F.lit(resolution << 52)).bitwiseOR(F.lit(low))


def center_child(cell: Column, own: int, resolution: int) -> Column:
    """Center child of an index of resolution ``own``: the digits in between are zero."""
    between = ((1 << 3 * (15 - own)) - 1) & ~((1 << 3 * (15 - resolution)) - 1)
    return cell.bitwiseAND(F.lit(~between)).bitwiseAND(F.lit(~(15 << 52))).bitwiseOR(F.lit(resolution << 52))
