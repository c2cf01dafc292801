"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one
row per digest, anti-joined with the index by sort-merge (the index side needs
no shuffle) and what is new is appended. Everything is DataFrame code. The number of buckets follows
from the batch that makes the table, one for ``BUCKET_ROWS`` digests. Appends add files
to the buckets, so Spark sorts a bucket again when it is joined, which is a merge of sorted runs; ``compact`` makes
them one file each.

Defined results: a null text counts as empty, so all null and empty texts are
one group. A null doc_id ranks below every other. If a row occurs several times
with the same doc_id and text, exactly one occurrence is kept. An empty input
gives an empty result. Columns other than doc_id and text are not looked at.

A batch may be ingested again after a crash: the index remembers the batch and doc_id that
stand for a digest, so the rows of a batch of the same name get the same answers. Rows of other batches with
that text go, whatever their doc_id, null included.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, keep_rows, row_key, text_column

BUCKET_ROWS, LEAST_BUCKETS = 4_000_000, 32


class DigestIndex:
    """Digests seen so far, each with the batch and doc_id that stand for it."""

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table, self.buckets = spark, table, buckets

    def _write(self, rows: DataFrame, table: str, buckets: int) -> None:
        (
            rows.repartition(buckets, "digest")
            .write.mode("append")
            .bucketBy(buckets, "digest")
            .sortBy("digest")
            .format("parquet")
            .saveAsTable(table)
        )

    def _append(self, rows: DataFrame) -> None:
        self._write(rows, self.table, self._buckets(0))

    def _buckets(self, rows: int) -> int:
        """Buckets of the table, or of one to be made for ``rows`` digests."""
        if self.spark.catalog.tableExists(self.table):
            told = {r[0]: r[1] for r in self.spark.sql(f"DESCRIBE EXTENDED {self.table}").collect()}
            return int(told["Num Buckets"])
        return self.buckets or max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))

    def read(self, rows: int = 0) -> DataFrame:
        """The index; made for ``rows`` digests if there is none."""
        if not self.spark.catalog.tableExists(self.table):
            if self.spark.catalog.tableExists(self._next):  # a crash between the two last steps of compact
                self.spark.sql(f"ALTER TABLE {self._next} RENAME TO {self.table}")
            else:
                empty = self.spark.createDataFrame([], "digest binary, index_id bigint, batch string")
                self._write(empty, self.table, self._buckets(rows))
        return self.spark.table(self.table)

    @property
    def _next(self) -> str:
        return f"{self.table}_next"

    def drop(self) -> None:
        for table in (self.table, self._next):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def compact(self) -> None:
        """Rewrite the buckets as one sorted file each, after many appends.

        The new table is whole before the old one goes, and ``read`` finishes a rewrite that was cut short.
        """
        rows = self.read()
        self.spark.sql(f"DROP TABLE IF EXISTS {self._next}")
        self._write(rows, self._next, self._buckets(0))
        self.spark.sql(f"DROP TABLE {self.table}")
        self.spark.sql(f"ALTER TABLE {self._next} RENAME TO {self.table}")

    def ingest(self, docs: DataFrame, batch: str = "") -> DataFrame:
        """Append the batch's new digests; return doc_id, keep_id, group_size, kept, digest per row."""
        keyed = cut(
            docs.select(
                F.col("doc_id").cast("bigint").alias("doc_id"),
                F.unhex(F.sha2(text_column(docs), 256)).alias("digest"),
                F.monotonically_increasing_id().alias("row_id"),
            ),
            "digests",
        )
        groups = keyed.groupBy("digest").agg(
            F.max(F.struct("doc_id", "row_id")).alias("top"), F.count(F.lit(1)).alias("group_size")
        )
        groups = cut(groups, "groups")
        seen = self.read(groups.count()).select("digest")
        fresh = groups.join(seen.hint("merge"), "digest", "left_anti")
        self._append(fresh.select("digest", F.col("top.doc_id").alias("index_id"), F.lit(batch).alias("batch")))
        own = (F.col("batch") == batch) & F.col("index_id").eqNullSafe(F.col("top.doc_id"))
        decided = cut(
            groups.join(self.read().hint("merge"), "digest").select(
                "digest", "group_size", F.col("index_id").alias("keep_id"), F.when(own, F.col("top.row_id")).alias("kept_row")
            ),
            "decided",
        )
        return keyed.join(decided, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("row_id") == F.col("kept_row"), F.lit(False)).alias("kept"),
            "digest",
        )


def dedup_batch(docs: DataFrame) -> DataFrame:
    """Decisions for a batch on its own: an index that starts empty and is dropped afterwards."""
    index = DigestIndex(docs.sparkSession, f"digest_index_{uuid.uuid4().hex[:12]}")
    try:
        return index.ingest(docs)
    finally:
        index.drop()


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = dedup_batch(docs)
    return keep_rows(docs, rows.select(row_key(rows, rows["digest"]).alias("key"), F.col("kept").cast("int").alias("keep")))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of each group of equal texts stays."""
    rows = dedup_batch(documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP1_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       CAST(count(*) OVER g AS BIGINT) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC) = 1 AS kept,
       text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
