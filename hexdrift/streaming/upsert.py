"""Vintages as micro-batches: the last row of a key wins, late events are dropped behind a watermark.

The model itself has no streams; these serve sources that deliver batches as files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def merge_latest(batch: DataFrame, path: str, keys: list[str], order: str) -> None:
    """Merge a batch into a table of snapshots; each merge writes a new snapshot and then names it.

    A batch that comes again writes the same rows, so a restart does no harm.
    """
    spark = batch.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(fs_path)) if fs.exists(fs_path) else []
    done = [n for n in names if n.startswith("v") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    every = batch.unionByName(spark.read.parquet(f"{path}/{done[-1]}")) if done else batch
    n = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))
    every.withColumn("_n", n).where("_n = 1").drop("_n").write.mode("overwrite").parquet(f"{path}/v{len(done):08d}")


def latest(spark, path: str) -> DataFrame:
    """The newest snapshot."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = sorted(s.getPath().getName() for s in fs.listStatus(fs_path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{s.getPath()}/_SUCCESS")))
    return spark.read.parquet(f"{path}/{done[-1]}")


def upsert_stream(stream: DataFrame, path: str, keys: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Keep the last row of each key of a stream in ``path``."""
    return (
        stream.writeStream.foreachBatch(lambda df, _: merge_latest(df, path, keys, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def windowed_tests(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Number and mean of measurements per window and type, behind a watermark."""
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", width), "event_type")
        .agg(F.count(F.lit(1)).alias("tests"), F.avg("value").alias("mean"))
        .select(F.col("window.start").alias("start"), "event_type", "tests", "mean")
    )
