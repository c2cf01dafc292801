"""Scopes, names and labels: which rows a run looks at, and what they are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C


def state_tokens(raw: Column) -> Column:
    """State tokens of a comma-separated text, each of two digits; null for 'all' and for no token at all."""
    parts = F.filter(F.transform(F.split(raw, ","), lambda t: F.trim(t)), lambda t: t != "")
    every = (F.size(parts) == 1) & (F.lower(F.element_at(parts, 1)) == "all")
    padded = F.transform(parts, lambda t: F.when(F.length(t) < 2, F.lpad(t, 2, "0")).otherwise(t))
    return F.when((F.size(parts) > 0) & ~every, padded)


def scope_key(raw: Column) -> Column:
    """Name of a state scope: its tokens in order, or 'all'."""
    return F.coalesce(F.array_join(F.array_sort(state_tokens(raw)), "-"), F.lit("all"))


def in_states(df: DataFrame, states: list[str]) -> DataFrame:
    """Rows of the wanted states, by state_fips, else by the start of county_geoid; all if there is neither or none is wanted."""
    if not states:
        return df
    if "state_fips" in df.columns:
        return df.where(F.lpad(F.col("state_fips").cast("string"), 2, "0").isin(states))
    return df.where(F.substring("county_geoid", 1, 2).isin(states)) if "county_geoid" in df.columns else df


def batches_of(df: DataFrame, key: str, state: str) -> DataFrame:
    """Batches whose key names a state or 'all'."""
    parts = F.split(F.col(key), "-")
    return df.where(F.array_contains(parts, state) | F.array_contains(parts, "all"))


def providers(df: DataFrame, wanted: list[int] | None, column: str = "provider_id") -> DataFrame:
    """Providers of a run: those asked for, or all that the catalog knows."""
    known = df.select(column).distinct()
    return known if wanted is None else known.where(F.col(column).isin(wanted))


def release(catalog: DataFrame, vintage: str, subtype: str, as_of: str, order: str) -> DataFrame:
    """The first filing of a vintage, by subtype or date; an error if there is none."""
    found = catalog.where((F.col(subtype).cast("string") == vintage) | (F.col(as_of).cast("string") == vintage)).orderBy(order).limit(1)
    if found.isEmpty():
        raise ValueError(f"no filing for vintage {vintage!r}")
    return found


def service_columns(services: DataFrame, names: dict[str, str], environment: int, column: str = "service") -> DataFrame:
    """Column of each service; an error names those that have none."""
    known = services.sparkSession.createDataFrame([(k, f"{v}_env{environment}") for k, v in names.items()], f"{column} string, hex_column string")
    lost = [r[0] for r in services.join(known, column, "left_anti").select(column).distinct().limit(20).collect()]
    if lost:
        raise ValueError(f"no column for services {', '.join(sorted(lost))}")
    return services.join(known, column)


def join_present(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on those of the keys that both sides have."""
    return left.join(right, [k for k in keys if k in left.columns and k in right.columns])


def whole(raw: Column) -> Column:
    """A number without its fraction; 0 for null, not a number and what is none."""
    x = raw.try_cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0).otherwise(x.try_cast("int"))


def run_key(text: Column) -> Column:
    """Part of a run's folder name."""
    return F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", "")


def tag(text: Column) -> Column:
    """Part of a file name; 'unknown' if nothing is left."""
    clean = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), r"[^\w.\-]+", "_"), "^_+|_+$", "")
    return F.when(clean == "", "unknown").otherwise(clean)


def service_name(text: Column) -> Column:
    """A service's name without blanks, brackets and slashes."""
    return F.regexp_replace(F.regexp_replace(text, "/", "-"), "[ ()]", "")


def severity_of_score(score: Column, flagged: Column) -> Column:
    """Badge by absolute score, for rows without a percentile."""
    out = F.when(flagged, "Flagged").otherwise("Below threshold")
    for least, name in reversed(C.LEGACY_SEVERITY):
        out = F.when(score >= least, name).otherwise(out)
    return out


def physics_label(selected: Column) -> Column:
    """Three-valued target of the calibration: null where nobody looked."""
    x = lambda n: F.coalesce(F.col(n).cast("double"), F.lit(0.0))
    small = x("added_km2") < C.MIN_ADDED_KM2
    explained = (x("new_site_share") >= C.NEW_SHARE) & (x("new_towers") >= 1)
    same = x("same_site_growth_share") >= C.SAME_SITE
    seen = same & ((x("added_frac_of_county") >= 0.05) | (x("blanket_fillin") >= 0.20))
    unseen = same & (x("added_frac_of_county") >= 0.15)
    return F.when(selected.isNull(), None).otherwise(~small & ~explained & F.when(selected, seen).otherwise(unseen))


def green_signal(r: Column, g: Column, b: Column) -> Column:
    """Signal of a rendered pixel by its green; null where it shows no coverage."""
    r, g, b = (c / F.lit(255.0) for c in (r, g, b))
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    gap = high - low
    turn = F.when(high == r, F.pmod((g - b) / gap, F.lit(6.0))).when(high == g, (b - r) / gap + 2).otherwise((r - g) / gap + 4)
    hue, depth = F.when(gap > 0, turn / 6), F.when(high > 0, gap / high).otherwise(0.0)
    green = (hue > C.GREEN[0]) & (hue < C.GREEN[1]) & (depth > C.GREEN[2]) & (high > C.GREEN[2])
    out = F.lit(None).cast("double")
    for least, dbm in reversed(C.GREEN_DBM):
        out = F.when(depth * high >= least, dbm).otherwise(out)
    return F.when(green, out)


def quadkey_point(key: Column) -> dict[str, Column]:
    """Longitude and latitude of the middle of a map tile, by its quadkey."""
    digits = F.transform(F.filter(F.split(key, ""), lambda c: c != ""), lambda c: c.cast("bigint"))
    step = lambda bit: F.aggregate(digits, F.lit(0).cast("bigint"), lambda s, c: s * 2 + (F.shiftright(c, bit).bitwiseAND(F.lit(1))))
    tiles = F.pow(F.lit(2.0), F.length(key))
    y = F.lit(3.141592653589793) * (1 - 2 * (step(1) + 0.5) / tiles)
    return {"lng": (step(0) + 0.5) / tiles * 360 - 180, "lat": F.degrees(F.atan(F.sinh(y)))}
