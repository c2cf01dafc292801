"""Line dedup with two Bloom filters.

A first pass hashes the distinct keys of every document and feeds two Bloom
filters: one of hashes seen once, one of hashes seen twice or more. The filters
of all parts are merged; what two parts' once-seen filters share counts as seen
twice. Only keys that the twice-seen filter holds can repeat, so only those are
shuffled, as 128-bit digests, for exact counting and for the choice of the
document that keeps the line. A false positive of the filter costs a shuffled
row and changes no result. Keys are told apart by 128 bits of xxh3, not by their text.

A filter has at most ``MOST_BITS`` bits, which bounds what is broadcast. Where that is too little for the lines of the input, hashes are
cut into as many equal ranges as need be, and each range in turn gets filters of its own, built from and
held against the written digests. The filters thus never fill up, however large the input.

Defined results: a null text is one empty line, as is an empty one. A null
doc_id counts as a document of its own that ranks below all others. Rows with
the same doc_id count as one document, and each is treated alike. Lines are
compared after stripping ASCII white space and lower-casing A-Z. An empty input
gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, text_column

LEAST_CHARS = 20
LEAST_DOCS = 3
#: Bits of each filter: at most this many; fewer for small inputs.
MOST_BITS = 1 << 30
PROBES = 3
CHUNK = 1 << 20
_NULL = -(1 << 63)


def keys_of(text: str, least: int) -> list[bytes]:
    """Keys of the lines of a text, b"" for lines whose key is shorter than ``least`` code points."""
    out = []
    for line in text.encode("utf-8", "replace").lower().split(b"\n"):
        k = line.strip()
        n = len(k)
        out.append(k if n >= least and (n >= 4 * least or len(k.decode("utf-8")) >= least) else b"")
    return out


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of each hash, a row for each probe."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(low + np.uint64(i) * high) & np.uint64(bits - 1) for i in range(PROBES)])


def _holds(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    out = np.ones(places.shape[1], bool)
    for p in places:
        out &= (bitmap[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def _insert(bitmap: np.ndarray, places: np.ndarray) -> None:
    for p in places:
        np.bitwise_or.at(bitmap, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))


def _hash_pass(docs: DataFrame, least: int) -> DataFrame:
    """Rows (doc, digests) for each document with long lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            doc_ids, found = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = set(keys_of(text.as_py(), least))
                own.discard(b"")
                if own:
                    doc_ids.append(doc)
                    found.append(b"".join(map(digest, own)))
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(found, pa.binary())], ["doc", "digests"])

    return docs.mapInArrow(run, "doc bigint, digests binary")


def _in_range(hashes: np.ndarray, part: int, parts: int) -> np.ndarray:
    """Whether a hash lies in a range, by bits that the filter's places do not start from."""
    return (hashes >> np.uint64(40)) % np.uint64(parts) == np.uint64(part)


def _filters(hashed: DataFrame, bits: int, part: int, parts: int) -> DataFrame:
    """Filter chunks (chunk, once, twice) of the hashes of a range, of each part of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        used = False
        for batch in batches:
            hashes = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)[::2]
            value, times = np.unique(hashes[_in_range(hashes, part, parts)], return_counts=True)
            places = _places(value, bits)
            _insert(twice, places[:, (times > 1) | _holds(once, places)])
            _insert(once, places)
            used |= len(value) > 0
        for c in range(0, bits // 8 if used else 0, CHUNK):
            a, b = once[c : c + CHUNK], twice[c : c + CHUNK]
            if a.any():
                raw = [pa.compress(x.tobytes(), "zstd", asbytes=True) for x in (a, b)]
                yield pa.RecordBatch.from_arrays([pa.array([c // CHUNK], pa.int32()), pa.array(raw[:1], pa.binary()), pa.array(raw[1:], pa.binary())], ["chunk", "once", "twice"])

    return hashed.select("digests").mapInArrow(run, "chunk int, once binary, twice binary")


def _merged(parts: DataFrame, bits: int) -> np.ndarray:
    """The twice-seen filter of all parts."""
    size = min(CHUNK, bits // 8)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a chunk come one after the other; one pair of arrays is held at a time.
        current, once, twice = None, None, None
        for batch in batches:
            for c, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                a, b = (np.frombuffer(pa.decompress(x, size, "zstd", asbytes=True), np.uint8) for x in (a, b))
                if c != current:
                    if current is not None:
                        yield row(current, once, twice)
                    current, once, twice = c, a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        if current is not None:
            yield row(current, once, twice)

    def row(c: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
        raw = [pa.array([pa.compress(x.tobytes(), "zstd", asbytes=True)], pa.binary()) for x in (once, twice)]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), *raw], ["chunk", "once", "twice"])

    schema = "chunk int, once binary, twice binary"
    # Two levels, so that a chunk's rows from very many parts do not meet in one task at once.
    rows = parts.select("chunk", "once", "twice")
    for keys in ([F.col("chunk"), F.pmod(F.xxhash64("once"), F.lit(16))], [F.col("chunk")]):
        rows = rows.repartition(*keys).sortWithinPartitions("chunk").mapInArrow(fold, schema)
    out = np.zeros(bits // 8, np.uint8)
    for c, raw in rows.select("chunk", "twice").collect():  # at most `bits`
        out[c * CHUNK : c * CHUNK + size] = np.frombuffer(pa.decompress(bytes(raw), size, "zstd", asbytes=True), np.uint8)
    return out


def _suspects(hashed: DataFrame, twice, bits: int, part: int, parts: int) -> DataFrame:
    """Rows (key, doc) of the digests of a range that the twice-seen filter holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None
        for batch in batches:
            if bitmap is None:
                bitmap = np.frombuffer(pa.decompress(twice.value, bits // 8, "zstd", asbytes=True), np.uint8)
            raw = batch.column(1).to_pylist()
            n = np.array([len(x) // 16 for x in raw], np.int64)
            all_of = np.frombuffer(b"".join(raw), np.uint64)
            hit = np.flatnonzero(_holds(bitmap, _places(all_of[::2], bits)) & _in_range(all_of[::2], part, parts))
            keys = np.ascontiguousarray(all_of.reshape(-1, 2)[hit])
            doc = np.repeat(batch.column(0).to_numpy(), n)[hit]
            data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(hit), [None, pa.py_buffer(keys.tobytes())])
            yield pa.RecordBatch.from_arrays([data.cast(pa.binary()), pa.array(doc, pa.int64())], ["key", "doc"])

    return hashed.mapInArrow(run, "key binary, doc bigint")


def line_dedup(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text of each row."""
    spark = docs.sparkSession
    slim = docs.select(
        F.coalesce(docs["doc_id"].cast("bigint"), F.lit(_NULL)).alias("doc"), text_column(docs).alias("text")
    )
    hashed = cut(_hash_pass(slim, least_chars), "lines")
    lines = hashed.agg(F.coalesce(F.sum(F.octet_length("digests")), F.lit(0))).first()[0] // 16
    wanted = 1 << (10 * lines).bit_length()  # ten bits a line at least
    bits = max(64, min(most_bits, max(1 << 16, wanted)))
    parts = max(1, wanted // bits)
    suspected = None
    for part in range(parts):
        twice = spark.sparkContext.broadcast(pa.compress(_merged(_filters(hashed, bits, part, parts), bits).tobytes(), "zstd", asbytes=True))
        found = cut(_suspects(hashed, twice, bits, part, parts), "suspects")
        twice.destroy()
        suspected = found if suspected is None else suspected.unionByName(found)
    repeated = (
        suspected.groupBy("key")
        .agg(F.count_distinct("doc").alias("docs"), F.max("doc").alias("keeper"))
        .where(F.col("docs") >= least_docs)
    )
    repeated = cut(repeated, "repeated")  # so that the join below deals both sides anew and can split a hot key
    dropped = (
        suspected.join(repeated, "key")
        .where("doc <> keeper")
        .groupBy("doc")
        .agg(F.collect_set("key").alias("keys"))  # at most the lines of one document
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc, text, keys in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                text, gone = text.as_py(), set(keys.as_py() or ())
                lines = text.split("\n")
                kept = lines
                if gone:
                    kept = [x for x, k in zip(lines, keys_of(text, least_chars), strict=True) if not k or digest(k) not in gone]
                out[0].append(None if doc == _NULL else doc)
                out[1].append(len(lines))
                out[2].append(len(lines) - len(kept))
                out[3].append("\n".join(kept) if gone else text)
                if sum(map(len, out[3][-64:])) > 1 << 22 or len(out[0]) == 4096:
                    yield _batch(out)
                    out = [[], [], [], []]
            if out[0]:
                yield _batch(out)

    def _batch(out: list[list]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc_id", "n_lines", "n_dropped", "kept_text"])

    return slim.join(dropped, "doc", "left").mapInArrow(apply, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_text string")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before dropping and dropped, and the digest of what stays."""
    rows = line_dedup(documents(spark, sf_dir))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


OP2_SQL = """
WITH lines AS (
  SELECT doc_id, i, line,
         translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
  SELECT l.doc_id, l.i, l.line, coalesce(l.doc_id <> r.keeper, false) AS gone
  FROM lines l LEFT JOIN repeated r ON l.key = r.key
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
