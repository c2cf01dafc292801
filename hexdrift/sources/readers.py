"""Readers of the model's file formats, and the registry of backends."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import GEOMETRY_NAMES, SIGNAL_NAMES


def alias(df: DataFrame, names: tuple[str, ...]) -> str | None:
    """The first of ``names`` that is a column, whatever its case."""
    lower = {c.lower(): c for c in df.columns}
    return next((lower[n] for n in names if n in lower), None)


def ring_of_wkt(wkt: Column) -> Column:
    """The outer ring of a WKT polygon as an array of points, without the closing one; null if it is none."""
    body = F.regexp_extract(wkt, r"(?i)^\s*POLYGON\s*\(\(([^()]*)\)", 1)
    point = lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].try_cast("double").alias("x"), F.split(F.trim(p), r"\s+").getItem(1).try_cast("double").alias("y"))
    points = F.transform(F.split(body, ","), point)
    closed = F.element_at(points, 1) == F.element_at(points, -1)
    return F.when(body != "", F.when(closed, F.slice(points, 1, F.size(points) - 1)).otherwise(points))


def wkt_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Rows (ring, signal) of a delimited file with a WKT column; rows without geometry go."""
    df = spark.read.csv(path, sep=sep, header=True, escape='"')
    geometry, signal = alias(df, GEOMETRY_NAMES), alias(df, SIGNAL_NAMES)
    if geometry is None:
        raise ValueError(f"no geometry column among {df.columns}")
    value = F.col(f"`{signal}`").try_cast("double") if signal else F.lit(None).cast("double")
    return df.select(ring_of_wkt(F.col(f"`{geometry}`")).alias("ring"), value.alias("signal")).where("ring IS NOT NULL")


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """Rows (properties, ring) of the polygons of a GeoJSON file."""
    schema = "features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
    f = spark.read.json(path, schema=schema, multiLine=True).select(F.explode("features").alias("f")).where("f.geometry.type = 'Polygon'")
    rings = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    ring = F.transform(rings[0], lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return f.select("f.properties", F.slice(ring, 1, F.size(ring) - 1).alias("ring"))


def _fields(spark: SparkSession, path: str, kind: str, least: int) -> DataFrame:
    f = spark.read.text(path).select(F.split("value", r"\|").alias("f"))
    return f.where((F.col("f")[0] == kind) & (F.size("f") >= least))


def _get(i: int) -> Column:
    return F.nullif(F.trim(F.get("f", F.lit(i))), F.lit(""))


def _degrees(at: int) -> Column:
    """Degrees of four fields: degrees, minutes, seconds, direction."""
    d, m, s = (_get(at + i).try_cast("double") for i in range(3))
    return (d + F.coalesce(m, F.lit(0.0)) / 60 + F.coalesce(s, F.lit(0.0)) / 3600) * F.when(F.upper(_get(at + 3)).isin("S", "W"), -1).otherwise(1)


def structure_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Rows (unique_id, registration_number, lat, lng) of coordinate records, the first of each key.

    Records have fifteen fields at least; places outside 15 to 72 degrees north
    and 60 to 180 degrees west are left out.
    """
    rows = _fields(spark, path, "CO", 15).select(_get(4).alias("unique_id"), _get(3).alias("registration_number"), _degrees(6).alias("lat"), _degrees(11).alias("lng"))
    rows = rows.where(F.col("lat").between(15, 72) & F.col("lng").between(-180, -60))
    key = F.coalesce("unique_id", F.concat(F.lit("reg:"), "registration_number"))
    first = F.row_number().over(W.partitionBy("_k").orderBy("lat", "lng"))
    return rows.withColumn("_k", key).where("_k IS NOT NULL").withColumn("_n", first).where("_n = 1").drop("_k", "_n")


def first_date(*texts: Column) -> Column:
    """The first text that is a date in one of the three known formats."""
    formats = ("MM/dd/yyyy", "yyyy-MM-dd", "MM-dd-yyyy")
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("date") for t in texts for f in formats])


def structure_registrations(spark: SparkSession, path: str) -> DataFrame:
    """Rows (unique_id, registration_number, status_code, height_m, event_date) of registration records."""
    height = F.coalesce(_get(30).try_cast("double"), _get(28).try_cast("double"))
    return _fields(spark, path, "RA", 33).select(
        _get(4).alias("unique_id"), _get(3).alias("registration_number"), _get(8).alias("status_code"), height.alias("height_m"), first_date(*[_get(i) for i in (12, 14, 9, 10, 11)]).alias("event_date")
    )


def structures(spark: SparkSession, coordinates: str, registrations: str, least_height: float = 15.0, status: str = "C") -> DataFrame:
    """Both kinds joined by unique_id, what is left by registration number; built ones that are high enough or of unknown height."""
    co, ra = structure_coordinates(spark, coordinates), structure_registrations(spark, registrations)
    by_id = co.join(ra.drop("registration_number"), "unique_id")
    left = co.join(by_id, "unique_id", "left_anti")
    rest = ra.join(by_id, "unique_id", "left_anti").drop("unique_id")
    every = by_id.unionByName(left.join(rest, "registration_number"))
    return every.where((F.col("status_code") == status) & (F.coalesce("height_m", F.lit(least_height)) >= least_height))


class Source(ABC):
    """Where coverage layers come from."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    @abstractmethod
    def layers(self) -> DataFrame:
        """All layers: vintage, provider_id, technology, cell, signal_dbm."""

    def vintages(self) -> list[str]:
        """Newest first; numeric names before others."""
        v = self.layers().select(F.col("vintage").cast("string").alias("v")).distinct()
        number = F.col("v").try_cast("bigint")
        return [r.v for r in v.orderBy(F.desc_nulls_last(number), F.desc("v")).collect()]

    def resolve(self, current: str | None = None, prior: str | None = None) -> tuple[str, str]:
        """The vintages to compare: those given, else the two newest."""
        known = [v for v in self.vintages() if v not in (current, prior)]
        found = [current or (known.pop(0) if known else None), prior or (known.pop(0) if known else None)]
        if None in found:
            raise ValueError("two vintages are needed")
        return found[0], found[1]

    def fetch(self, provider_id: int, technology: str, vintage: str) -> DataFrame:
        """One layer; the predicates reach the partitions and the scan."""
        return self.layers().where((F.col("vintage") == vintage) & (F.col("provider_id") == provider_id) & (F.col("technology") == technology))


class PartitionedFiles(Source):
    """A folder partitioned by vintage, provider and service, as ``write_layers`` leaves it."""

    def layers(self) -> DataFrame:
        return self.spark.read.parquet(self.root)


class LineItems(Source):
    """The driver's line items as observations."""

    def layers(self) -> DataFrame:
        from ..operators.layers import strongest
        from .model import observations

        return strongest(observations(self.spark, self.root), ["vintage", "provider_id", "technology", "cell"])


SOURCES: dict[str, type[Source]] = {"files": PartitionedFiles, "lineitem": LineItems}


def source(name: str, spark: SparkSession, root: str) -> Source:
    """A backend by name."""
    if name not in SOURCES:
        raise ValueError(f"no backend {name}; there are {', '.join(SOURCES)}")
    return SOURCES[name](spark, root)
