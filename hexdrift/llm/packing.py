"""Best-fit packing of documents into sequences of fixed capacity.

The plan is made on the histogram of piece lengths, which has at most as many
rows as the capacity, however many documents there are. Pieces above a third of
the capacity ("large") are matched first: from the longest on, each takes the
longest large partner that still fits, so a sequence holds two at most. Smaller
pieces follow by length, each into the fullest sequence with room for it. Both
steps handle all pieces of a length in all alike sequences at once, so the plan
is a short list of patterns with multiplicities. A piece finds its place from
its rank among the pieces of its length; ranks are counted per input partition
and offset, so no length, however frequent, meets in one task.

Defined results: a null text is empty, and its document is the end id alone.
Repeated rows are packed each time; their doc_id and piece repeat. An empty
input gives an empty result. Texts are encoded whole; documents longer than the
capacity are cut into pieces, others never. Other columns are not looked at.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, documents, text_column
from .tokens import VOCABULARY, encoded

CAPACITY = 2048


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for all pieces of each length.

    Rows (length, first rank, number of ranks, ranks per sequence, first
    sequence, offset): rank r of that run lies in sequence ``first sequence +
    (r - first rank) // ranks per sequence`` at ``offset + length * ((r - first
    rank) % ranks per sequence)``.
    """
    left = {n: c for n, c in histogram.items() if c}
    patterns: list[tuple[int, list[tuple[int, int]]]] = []  # multiplicity, (length, how many) in order
    large = sorted(n for n in left if 3 * n > capacity)
    for big in reversed(large):
        while left.get(big):
            at = bisect.bisect_right(large, min(capacity - big, big)) - 1
            while at >= 0 and not left.get(large[at]):
                at -= 1
            if at < 0:
                patterns.append((left.pop(big), [(big, 1)]))
                break
            mate = large[at]
            if mate == big and left[big] == 1:
                rest = at - 1
                while rest >= 0 and not left.get(large[rest]):
                    rest -= 1
                if rest < 0:
                    patterns.append((left.pop(big), [(big, 1)]))
                    break
                mate = large[rest]
            times = left[big] // 2 if mate == big else min(left[big], left[mate])
            patterns.append((times, [(big, 2)] if mate == big else [(big, 1), (mate, 1)]))
            for n in (big, mate):
                left[n] -= times
    room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    gaps: list[int] = []  # sorted, of the lists in room

    def put(times: int, items: list[tuple[int, int]]) -> None:
        gap = capacity - sum(n * k for n, k in items)
        if gap not in room:
            room[gap] = []
            bisect.insort(gaps, gap)
        room[gap].append((times, items))

    for p in patterns:
        put(*p)
    for small in sorted((n for n in left if left[n] and 3 * n <= capacity), reverse=True):
        count = left[small]
        while count:
            at = bisect.bisect_left(gaps, small)
            if at == len(gaps):
                k = capacity // small
                if count >= k:
                    put(count // k, [(small, k)])
                if count % k:
                    put(1, [(small, count % k)])
                break
            gap = gaps[at]
            times, items = room[gap].pop()
            if not room[gap]:
                del room[gap]
                gaps.pop(at)
            k = min(gap // small, count)
            used = min(times, count // k)
            if times > used:
                put(times - used, items)
            put(used, [*items, (small, k)])
            count -= used * k
    rows, rank, first = [], dict.fromkeys(histogram, 0), 0
    for gap in sorted(room):
        for times, items in room[gap]:
            offset = 0
            for n, k in items:
                rows.append((n, rank[n], times * k, k, first, offset))
                rank[n] += times * k
                offset += n * k
            first += times
    return rows


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = 0) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and its rank among those of its length in its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for a, b, ids, counts in encoded(batch, vocabulary):
                ends = np.cumsum(counts)
                whole = np.insert(ids, ends, end_id).astype("<u4")
                total = counts + 1
                each = -(-total // capacity)
                n = int(each.sum())
                doc = np.repeat(np.arange(b - a), each)
                piece = np.arange(n) - np.repeat(np.cumsum(each) - each, each)
                start = piece * capacity
                length = np.minimum(capacity, total[doc] - start)
                raw = memoryview(whole.tobytes())
                at = (np.repeat(np.cumsum(total) - total, each) + start) * 4
                crc = [zlib.crc32(raw[i:j]) for i, j in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                first = np.r_[True, ordered[1:] != ordered[:-1]]
                within = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
                rank = np.empty(n, np.int64)
                rank[order] = within + seen[ordered]
                np.add.at(seen, length, 1)
                keys = batch.column("doc_id").slice(a, b - a).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(n, part), pa.int32()), pa.array(rank, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"],
                )

    slim = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_column(docs).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = 0) -> DataFrame:
    """Place of every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    # Written once: a part's ranks hold for the rows as they were written.
    rows = cut(pieces(docs, capacity, vocabulary, end_id), "pieces")
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = cut(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "ranks")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most `capacity` rows
    table = np.array(plan(histogram, capacity) or [(0,) * 6], np.int64)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]  # its size depends on the capacity alone

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(key, length << 48 | rank, "right") - 1]
            r = rank - row[:, 1]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(row[:, 4] + r // row[:, 3]), pa.array(row[:, 5] + length * (r % row[:, 3]))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    # There is a row for each length and part, which grows with the input: never broadcast.
    ranked = rows.join(counts.drop("n").hint("merge"), ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return pack(documents(spark, sf_dir))
