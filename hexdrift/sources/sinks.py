"""Writers of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_layers(df: DataFrame, path: str) -> None:
    """Layers partitioned by vintage, provider and service; only the partitions in ``df`` are replaced."""
    keys = ["vintage", "provider_id", "technology"]
    df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_scored(df: DataFrame, path: str, batch_ts: str, states: str) -> None:
    """A batch of scored rows under its own partition."""
    rows = df.withColumn("batch_ts", F.lit(batch_ts)).withColumn("batch_states", F.lit(states))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_ts").parquet(path)


def write_states(df: DataFrame, path: str, batch_ts: str) -> None:
    """Coverage of a batch by state: states in ``df`` are replaced, others stay.

    Rows without a state go under Hive's default partition. The manifest, a row a
    state with its rows and batch, is written once the data are there, so a state it lists is whole.
    """
    df.withColumn("batch_ts", F.lit(batch_ts)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("state_fips").parquet(f"{path}/coverage")
    rows = df.groupBy("state_fips").agg(F.count(F.lit(1)).alias("n")).withColumn("batch_ts", F.lit(batch_ts))
    rows.withColumn("state", F.col("state_fips")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("state_fips").json(f"{path}/manifest")


def write_ranking(df: DataFrame, path: str) -> None:
    """The ranking as one CSV file with a header; it has a row a unit and county."""
    df.orderBy("rank").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def summary(df: DataFrame, missing: int = 0, top: int = 25) -> str:
    """Markdown of the first flagged rows."""
    rows = df.where("flag_for_review").orderBy("rank").limit(top).collect()
    head = ["# Review list", "", f"Status: {'INCOMPLETE' if missing else 'complete'}", "", "| rank | provider | service | county | score | reason |", "|-|-|-|-|-|-|"]
    return "\n".join([*head, *(f"| {r['rank']} | {r.provider_id} | {r.technology} | {r.county_geoid} | {r.priority_score:.3f} | {r.flag_reason} |" for r in rows)]) + "\n"
