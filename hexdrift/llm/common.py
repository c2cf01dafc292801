"""Plumbing shared by the corpus operators: the shared folder, cut lineage, word splitting."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whether a query's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """URI of a folder that driver and executors share.

    It lies under ``spark.checkpoint.dir``. Only where that is unset and Spark runs
    on one machine a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if app not in _own_dirs:
            _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="hexdrift-")
        base = _own_dirs[app]
    return f"{base.rstrip('/')}/corpus-{app}"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """URI of a folder of its own for ``name``; deleted when the application ends."""
    uri = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return uri


def discard(spark: SparkSession, uri: str) -> None:
    """Delete a folder that nothing will read again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later plans start from those files, so a lost executor costs a reread and
    nothing upstream runs twice.
    """
    spark = df.sparkSession
    uri = fresh_dir(spark, name) + "/t"
    # What was shuffled for these files is not read again either.
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(uri)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(uri)


def lean(run):
    """``run`` over Arrow batches; what it freed goes back to the system when it ends.

    A Python worker lives on after its task, and what its allocators keep counts as its executor's memory
    while other workers run.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return wrapped


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_column(df: DataFrame, name: str = "text"):
    """The text with null counted as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def row_key(df: DataFrame, digest=None):
    """Digest of a row's doc_id and text, or of its doc_id and its text's SHA-256 ``digest``."""
    digest = F.sha2(text_column(df), 256) if digest is None else F.lower(F.hex(digest))
    return F.unhex(F.sha2(F.concat_ws(":", df["doc_id"].cast("bigint").cast("string"), digest), 256))


def keep_rows(docs: DataFrame, told: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay by decisions (key, keep), one for each row's ``row_key``.

    Of rows with one key, as many are equal in doc_id and text, so that it does not matter which
    of them stays: none where no decision says 1, else one. Only keys of which
    rows go take part in the join, which shuffles each text once at every size.
    """
    keys = told.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("keep").alias("keep")).where("n > 1 OR keep = 0")
    keys = cut(keys.select(F.col("key").alias("_hd_key"), F.col("keep").alias("_hd_keep")), "going")
    marked = docs.withColumn("_hd_key", row_key(docs))
    out = marked.join(keys.select("_hd_key").hint("merge"), "_hd_key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    if keys.where("_hd_keep = 1").isEmpty():
        return out
    whole = F.any_value(F.struct(*[marked[f"`{c}`"] for c in docs.columns])).alias("_hd_row")
    once = marked.join(keys.where("_hd_keep = 1").select("_hd_key"), "_hd_key", "left_semi").groupBy("_hd_key").agg(whole)
    return out.unionByName(once.select(*[F.col("_hd_row").getField(c).alias(c) for c in docs.columns]))


#: ASCII characters other than letters, digits and _ separate words, as do these ranges.
_SEPARATORS = bytes(c if c > 127 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
_UNICODE_SEPARATORS = re.compile(
    "[\u0080-©«-´¶-¹»-¿×÷ -⁯⸀-⹿　-〿﻿]+"
)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8; punctuation and white space separate them."""
    if not text:
        return []
    low = text.lower()
    if not low.isascii():
        low = _UNICODE_SEPARATORS.sub(" ", low)
    return low.encode("utf-8", "replace").translate(_SEPARATORS).split()


def slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes sum to about ``most``; a larger item stands alone."""
    start, total, at = 0, 0, 0
    for at, n in enumerate(sizes):
        if at > start and total + n > most:
            yield start, at
            start, total = at, 0
        total += n
    if total or start <= at:
        yield start, at + 1
