"""WARC archives with an index that is written first.

Pages become WARC/1.1 records, each a gzip member of its own. While they are
written, an index row is kept for every record: file, offset, length, URL and
payload digest. Reading starts from the index: selected rows are sorted by file
and offset, neighbouring ranges are coalesced into large reads, and the records
are cut out of what was read.

Of records with equal payloads of at least ``least_bytes`` bytes the one with
the smallest page_id is a response; the others are revisit records without the
payload that name it.

Defined results: null html is an empty payload; a null url is written as
``urn:page:<page_id>``. A null page_id ranks after all others, 2^63 - 1 included, and is written as
an empty record name. If a page_id occurs several times with the same payload,
its first occurrence counts as the response. An empty input gives no files and an empty
result. Payloads of any length are written whole. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh_dir
from .tokens import open_fs

#: Ranges closer than this are read together, up to this many bytes at once.
GAP, RUN = 1 << 16, 1 << 23
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
#: A read task is meant to have this many bytes of the archives, in runs of SPAN.
READ, SPAN = 1 << 27, 1 << 22


def digest32(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, uncompressed. A revisit has the HTTP header only; its Content-Length is the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_uri(page)}",
        f"WARC-Target-URI: {_clean(url) if url else _uri(page)[1:-1]}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{digest32(block)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _clean(url: str) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url)


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Record header, HTTP header and body of an uncompressed record; digests are verified."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if "sha1:" + digest32(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, body = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), body


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_archives(pages: DataFrame, uri: str, least_bytes: int = 0) -> DataFrame:
    """Write all pages below ``uri``; return the index, one row a record: page_id, url, digest, kind, file, offset, length."""
    page = pages["page_id"].cast("bigint")
    payload = F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")
    keyed = pages.select(page.alias("page"), pages["url"].cast("string").alias("url"), payload.alias("payload"))
    keyed = keyed.withColumn("sha", F.unhex(F.sha1("payload")))
    who = F.coalesce(F.col("page").cast("string"), F.lit(""))
    named = cut(keyed.select("page", "sha", F.octet_length("payload").cast("bigint").alias("size")), "payloads")
    least = F.min(F.struct(F.col("page").isNull().alias("null"), F.col("page"))).alias("least")
    first = named.where(F.col("size") >= least_bytes).groupBy("sha").agg(least, F.count(F.lit(1)).alias("n"))
    copies = named.join(first.where("n > 1"), "sha").select(who.alias("who"), "sha", F.col("least.page").alias("first"), F.lit(True).alias("copy")).distinct()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        store, root = open_fs(uri)
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        draft, out, at, last = f"{root}/.{name}-{uuid.uuid4().hex}", None, 0, None
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            for row in zip(*(batch.column(i) for i in range(6)), strict=True):
                p, url, body, sha, first, copy = (x.as_py() for x in row)
                revisit = copy is not None and (first != p or last == (p, sha))
                last = (p, sha)
                digest = base64.b32encode(sha).decode()
                raw = _gzip(record(p, url, body, digest, first, revisit))
                if out is None:
                    out = store.open_output_stream(draft)
                out.write(raw)
                for col, x in zip(rows, (p, url, digest, "revisit" if revisit else "response", name, at, len(raw)), strict=True):
                    col.append(x)
                at += len(raw)
            if rows[0]:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], _INDEX)
        if out is not None:
            out.close()
            store.move(draft, f"{root}/{name}")

    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Payloads are shuffled once: the join reuses the partitioning.
    dealt = keyed.withColumn("who", who).repartition(parts, "who", "sha")
    placed = (
        dealt.join(copies.hint("merge"), ["who", "sha"], "left")
        .sortWithinPartitions("who", "sha")
        .select("page", "url", "payload", "sha", "first", "copy")
    )
    index = placed.mapInArrow(write, "page_id bigint, url string, digest string, kind string, file string, offset bigint, length bigint")
    return cut(index, "index")


_INDEX = ["page_id", "url", "digest", "kind", "file", "offset", "length"]


def read_records(selected: DataFrame, uri: str) -> DataFrame:
    """The records of the selected index rows: page_id, url, record_type, refers_to, payload_bytes, payload_digest, body.

    Digest and size of a response are those of the body as read; a revisit's come
    from its record and HTTP headers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_fs(uri)
        name, source, run = None, None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if not run:
                return
            begin = run[0][0]
            source.seek(begin)
            raw = source.read(run[-1][0] + run[-1][1] - begin)
            out: list[list] = [[] for _ in range(7)]
            for at, n in run:
                fields, http, body = parse(zlib.decompress(raw[at - begin : at - begin + n], 31))
                page = fields["WARC-Record-ID"][10:-1]
                revisit = fields["WARC-Type"] == "revisit"
                of = fields.get("WARC-Refers-To", "<urn:page:>")[10:-1] if revisit else ""
                if not revisit and "sha1:" + digest32(body) != fields["WARC-Payload-Digest"]:
                    raise ValueError(f"damaged payload of page {page}")
                values = (
                    int(page) if page else None,
                    fields["WARC-Target-URI"],
                    fields["WARC-Type"],
                    int(of) if of else None,
                    int(http["Content-Length"]) if revisit else len(body),
                    fields["WARC-Payload-Digest"][5:] if revisit else digest32(body),
                    None if revisit else body,
                )
                for col, x in zip(out, values, strict=True):
                    col.append(x)
            run.clear()
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "body"]
        for batch in batches:
            for file, at, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if file != name or run and (at - run[-1][0] - run[-1][1] > GAP or at + n - run[0][0] > RUN):
                    yield from flush()
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, store.open_input_file(f"{root}/{file}")
                run.append((at, n))
        yield from flush()

    # Records of the same stretch of a file are read together; stretches are dealt evenly over tasks by bytes.
    total = selected.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // READ))
    return (
        selected.select("file", "offset", "length")
        .repartition(tasks, "file", (F.col("offset") / SPAN).cast("bigint"))
        .sortWithinPartitions("file", "offset")
        .mapInArrow(read, "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, body binary")
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record in the archives tells it."""
    uri = fresh_dir(spark, "warc")
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), uri)
    return read_records(index, uri).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages
),
b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
    4 * (strpos('0123456789abcdef', substr(hex, i, 1)) - 1) + 1, 4)), '') AS bits FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT)
           + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest,
       CASE WHEN row_number() OVER w = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN row_number() OVER w > 1 THEN min(page_id) OVER (PARTITION BY hex) END AS refers_to
FROM b WINDOW w AS (PARTITION BY hex ORDER BY page_id)
"""
