"""Sharding along a Hilbert curve over document metadata.

Three dimensions (source, language, size) are quantised to five bits each, so there are
at most 32,768 cells. The cuts are quantiles in the order of the values themselves, so a cell covers a range of each
column and about as many rows as any other. Rows are ordered by the curve index of their cell and the order is cut
into runs of equal counts, so a shard covers a compact region and its files can be pruned by their least and
greatest values in any dimension. Strings are compared by the seven bytes after what all have in common;
those alike in them share a cell.

The global rank needs no global sort: counts per cell are summed along the
curve and rows are only ranked inside a cell. A cell with many rows is first
dealt into sub-cells by a hash of the row, so that no window partition holds more
than about 1/4096 of all rows, unless that many are equal in doc_id, text and size. Everything is DataFrame code; the
broadcast tables have at most 32,768 + 4,096 rows, whatever the input.

Defined results: a null text has no bytes, a null source or language comes before all
others, a null doc_id sorts first in its sub-cell. Repeated rows each get a place of their
own. An empty input gives an empty result; fewer rows than shards leave shards
empty. Tables without a source or language have one value there. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, documents, fresh_dir, text_column

DIMENSIONS, BITS = 3, 5
PIECES = 4096
#: Accuracy of the quantiles: their ranks are right to one part in this many.
ACCURACY = 10_000


def hilbert_index(coordinates: list[Column]) -> Column:
    """Curve index of ``DIMENSIONS`` coordinates of ``BITS`` bits (Skilling's transposed form, 2004)."""
    steps = F.array(
        *[
            F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
            for b in range(BITS - 1, 0, -1)
            for i in range(DIMENSIONS)
        ]
    )

    def undo(s: Column, step: Column) -> Column:
        low = step["q"] - 1
        first, own = s[0], F.element_at(s, step["i"] + 1)
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        hit = own.bitwiseAND(step["q"]) != 0

        def one(x: Column, k: Column) -> Column:
            flipped = F.when(k == 0, x.bitwiseXOR(low)).otherwise(x)
            swapped = F.when((k == 0) | (k == step["i"]), x.bitwiseXOR(swap)).otherwise(x)
            return F.when(hit, flipped).when(step["i"] == 0, x).otherwise(swapped)

        return F.transform(s, one)

    def finish(s: Column) -> Column:
        gray = [s[0]]
        for i in range(1, DIMENSIONS):
            gray.append(gray[-1].bitwiseXOR(s[i]))
        turn = F.lit(0)
        for b in range(BITS - 1, 0, -1):
            turn = turn.bitwiseXOR(F.when(gray[-1].bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(0))
        out = F.lit(0)
        for b in range(BITS):
            for i in range(DIMENSIONS):
                bit = F.shiftright(gray[i].bitwiseXOR(turn), b).bitwiseAND(F.lit(1))
                out = out + F.shiftleft(bit, b * DIMENSIONS + DIMENSIONS - 1 - i)
        return out

    return F.aggregate(steps, F.array(*[c.cast("int") for c in coordinates]), undo, finish)


def _order(column: Column, shared: int) -> Column:
    """Seven bytes of a string after ``shared`` ones, as a number of the same order; -1 for null."""
    tail = F.rpad(F.hex(F.substring(column.cast("string").cast("binary"), shared + 1, 7)), 14, "0")
    return F.coalesce(F.conv(tail, 16, 10).cast("bigint"), F.lit(-1))


def _values(docs: DataFrame) -> list[Column]:
    """The dimensions as numbers."""
    names = [c for c in ("source", "lang") if c in docs.columns]
    ends = docs.agg(F.lit(0), *[f(docs[c].cast("string").cast("binary")) for c in names for f in (F.min, F.max)]).first()[1:]
    out = []
    for i, c in enumerate(names):
        low, high = (bytes(x or b"") for x in ends[2 * i : 2 * i + 2])
        shared = next((k for k, (x, y) in enumerate(zip(low, high, strict=False)) if x != y), min(len(low), len(high)))
        out.append(_order(docs[c], shared))
    out += [F.lit(0).cast("bigint")] * (2 - len(names))
    return [*out, F.octet_length(text_column(docs)).cast("bigint")]


def _cells(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the quantised dimensions of each row."""
    values, levels = _values(docs), 1 << BITS
    marks = F.array(*[F.lit(k / levels) for k in range(1, levels)])
    cuts = docs.agg(*[F.percentile_approx(v, marks, ACCURACY).alias(f"d{i}") for i, v in enumerate(values)]).first()
    text = text_column(docs)
    kept = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        *[v.alias(f"v{i}") for i, v in enumerate(values)],
    )
    level = lambda i: sum(((F.col(f"v{i}") > c).cast("int") for c in cuts[i] or []), F.lit(0))
    return kept.select("doc_id", "size", "text_crc32", *[level(i).alias(f"d{i}") for i in range(DIMENSIONS)])


def hilbert_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and the curve index of each row; counts differ by one at most."""
    rows = cut(_cells(docs), "cells")
    cell = [f"d{i}" for i in range(DIMENSIONS)]
    counts = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(W.partitionBy())  # at most 32,768 rows meet here
    curve = cut(
        counts.select(
            *cell,
            hilbert_index([F.col(c) for c in cell]).alias("curve"),
            F.ceil(F.col("n") / F.ceil(total / PIECES)).cast("int").alias("parts"),
            total.alias("total"),
        ),
        "curve",
    )
    dealt = rows.join(F.broadcast(curve), cell).select(
        "doc_id",
        "size",
        "text_crc32",
        "curve",
        "total",
        F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.col("parts")).cast("int").alias("part"),
    )
    along = W.orderBy("curve", "part").rowsBetween(W.unboundedPreceding, -1)
    before = (
        dealt.groupBy("curve", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("curve", "part", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    )
    inside = W.partitionBy("curve", "part").orderBy("doc_id", "text_crc32", "size")
    ranked = (
        dealt.withColumn("inside", F.row_number().over(inside) - 1)
        .join(F.broadcast(cut(before, "before")), ["curve", "part"])
        .withColumn("rank", F.col("before") + F.col("inside"))
        .withColumn("shard", F.expr(f"cast(rank * {shards} div total as int)"))
    )
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        F.expr(f"rank - (shard * total + {shards} - 1) div {shards}").cast("bigint").alias("slot"),
        "curve",
    )


def write_shards(docs: DataFrame, uri: str | None = None, shards: int = 24) -> str:
    """Write whole rows as one folder a shard, in curve order inside; return the folder.

    A shard is written by as many tasks as its rows fill. Rows equal in doc_id and text go where the
    first of them goes.
    """
    uri = uri or fresh_dir(docs.sparkSession, "shards") + "/t"
    who = lambda doc, crc, size: F.struct(F.coalesce(doc.cast("string"), F.lit("")).alias("doc"), crc.alias("crc"), size.alias("size"))
    places = hilbert_shards(docs, shards)
    places = places.groupBy(who(places["doc_id"], places["text_crc32"], places["size"]).alias("_hd_who")).agg(F.min(F.struct("shard", "slot")).alias("_hd_place"))
    text = text_column(docs)
    marked = docs.withColumn("_hd_who", who(docs["doc_id"].cast("bigint"), F.crc32(text), F.octet_length(text).cast("bigint") + 8))
    tasks = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (
        marked.join(places, "_hd_who")
        .select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_hd_place.shard").alias("_hd_shard"), F.col("_hd_place.slot").alias("_hd_slot"))
        .repartitionByRange(tasks, "_hd_shard", "_hd_slot")
        .sortWithinPartitions("_hd_shard", "_hd_slot")
        .drop("_hd_slot")
        .write.partitionBy("_hd_shard")
        .parquet(uri)
    )
    return uri


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 24 shards along the curve, counts at most one apart."""
    rows = hilbert_shards(documents(spark, sf_dir), 24)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
