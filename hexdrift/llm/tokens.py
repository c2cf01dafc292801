"""Token ids of whole texts, and a compact file format for them.

Texts are encoded by the public word-level BPE vocabulary. White space ends a
token there, so each white-space-separated chunk is encoded once and looked up
afterwards. Files hold ids in Simple-8b words: a selector of four bits says how
many ids of how many bits share the other sixty. Ids of 2^60 and more are
escaped: selector 0, then the id as a word of its own. Blocks of 1,024 ids start
at a word of their own and the footer has their sizes, so that blocks can be
found, skipped and decoded with array operations.

Defined results: a null text is empty and yields the end id only. Documents are
written in ascending doc_id order, null first, those of one doc_id by their text; repeated rows are written each
time. An empty input gives no files and an empty result. Other columns are not
looked at. A text of any length is encoded whole.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh_dir, slices, text_column

VOCABULARY = "word_bpe_49k.json"
#: Chunks kept in a worker's cache; it starts anew when full.
CACHE = 1_000_000
END_ID = 1
#: A file takes about this many bytes of text.
FILE_BYTES = 1 << 29


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level BPE."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Encodes batches of texts; equal to ``Tokenizer.encode(text, add_special_tokens=False)``."""

    #: A lower-case Latin word and the stops after it: no normaliser changes it, the splitter cuts it in two.
    _plain = re.compile("([a-zß-öø-ÿĀ-ɏ]+)([.,]*)")

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.stops: dict[str, array] = {}
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.words: dict[str, int] = {}
        self.flat, self.ends = array("I"), array("q", [0])

    def _add(self, ids) -> int:
        self.flat.extend(ids)
        self.ends.append(len(self.flat))
        return len(self.ends) - 2

    def _word(self, word: str) -> int:
        piece = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        self.words[word] = code = self._add([t.id for t in self.model.tokenize(piece)])
        return code

    def _learn(self, chunks: list[bytes]) -> list[int]:
        """Codes of chunks that are not in the cache yet."""
        odd, plain, out = [], self._plain.fullmatch, []
        words, flat, ends = self.words, self.flat, self.ends
        for at, chunk in enumerate(chunks):
            text = chunk.decode()
            low = text.lower()
            word = low.rstrip(".,")
            code = words.get(word)
            if code is None:
                # Known words are plain by themselves; others are looked at once.
                if not plain(low):
                    odd.append((at, text))
                    out.append(0)
                    continue
                code = self._word(word)
            stops = low[len(word) :]
            if stops:
                if stops not in self.stops:
                    self.stops[stops] = array("I", [t.id for t in self.model.tokenize(stops)])
                code = self._add(flat[ends[code] : ends[code + 1]] + self.stops[stops])
            out.append(code)
        found = self.tokenizer.encode_batch_fast([t for _, t in odd], add_special_tokens=False) if odd else []
        for (at, _), e in zip(odd, found, strict=True):
            out[at] = self._add(e.ids)
        self.codes.update(zip(chunks, out, strict=True))
        return out

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        if not isinstance(texts, pa.Array):
            texts = pa.array([t and t.encode("utf-8", "replace").decode() for t in texts], pa.large_string())
        # Only the distinct chunks of a piece become Python objects.
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        chunks = split.flatten().dictionary_encode()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        distinct = chunks.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        code = [*map(self.codes.get, distinct)]
        new = [i for i, c in enumerate(code) if c is None]
        if len(self.codes) + len(new) > CACHE:
            self._clear()
            code = self._learn(distinct)
        else:
            for i, c in zip(new, self._learn([distinct[i] for i in new]), strict=True):
                code[i] = c
        code = np.array(code, np.int64)[chunks.indices.to_numpy()]
        bounds = np.array(self.ends)
        start, size = bounds[code], np.diff(bounds)[code]
        after = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(start - after[:-1], size) + np.arange(after[-1])
        return np.array(self.flat, np.uint32)[at], np.diff(after[ends])


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The worker's encoder, kept between tasks."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def encoded(batch: pa.RecordBatch, vocabulary: str, most: int = 4_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces of a batch with columns doc_id and text: first row, row after the last, ids, ids per text."""
    texts = batch.column("text")
    bytes_of = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(bytes_of.tolist(), most):
        ids, counts = encoder(vocabulary).encode(texts.slice(a, b - a))
        yield a, b, ids, counts


# --- Simple-8b ---------------------------------------------------------------

BLOCK = 1024
#: By selector: ids in a word and bits of each, as published for Simple-8b; 0 is our escape, 1 a run of zeros.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_LIMITS = np.array([1 << int(w) for w in WIDTHS[1:]], np.uint64)
#: The selector that an id below 2^16 needs at least.
_SMALL = (np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), "right") + 1).astype(np.uint8)
_MAGIC = b"HXS8\x01\x00\x00\x00"


def _windows(need: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each selector of several ids: the largest of ``need`` over as many columns from each column on."""
    done = {1: need}
    for n in sorted(int(c) for c in COUNTS[1:15]):
        a = max(k for k in done if k < n)
        b = min((k for k in done if k >= n - a), default=a)
        x, y = done[a], done[b]
        out = x.copy()
        np.maximum(out[:, : -(n - b)], y[:, n - b :], out=out[:, : -(n - b)])
        done[n] = out
        yield int(np.flatnonzero(COUNTS[1:15] == n)[0]) + 1, out


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all blocks in a row, words of each block, and whether a block has escapes."""
    ids = np.asarray(ids, np.uint64)
    blocks = -(-len(ids) // BLOCK)
    grid = np.zeros((blocks, BLOCK + 120), np.uint64)
    full = len(ids) // BLOCK
    grid[:full, :BLOCK] = ids[: full * BLOCK].reshape(full, BLOCK)
    if full < blocks:
        grid[full, : len(ids) - full * BLOCK] = ids[full * BLOCK :]
    if not len(ids) or ids.max() < len(_SMALL):
        need = _SMALL[grid]
    else:
        need = (np.searchsorted(_LIMITS, grid.ravel(), "right") + 1).astype(np.uint8).reshape(grid.shape)
    choice = np.where(need > 15, 0, 15).astype(np.uint8)
    for selector, most in _windows(need):
        choice[most <= selector] = selector
    length = np.full(blocks, BLOCK)
    if full < blocks:
        length[-1] = len(ids) - full * BLOCK
    starts = np.zeros(grid.shape, bool)
    live, at = np.arange(blocks), np.zeros(blocks, np.int64)
    while len(live):
        starts[live, at] = True
        at = at + COUNTS[choice[live, at]]
        on = at < length[live]
        live, at = live[on], at[on]
    where = np.flatnonzero(starts)
    chosen, row = choice.ravel()[where], where // grid.shape[1]
    width = 1 + (chosen == 0)
    place = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    flat = grid.ravel()
    for s in range(1, 16):
        sel = chosen == s
        if not sel.any():
            continue
        value = np.full(int(sel.sum()), np.uint64(s) << np.uint64(60))
        if WIDTHS[s]:
            for k in range(int(COUNTS[s])):
                value |= flat[where[sel] + k] << np.uint64(k * int(WIDTHS[s]))
        words[place[sel]] = value
    escapes = chosen == 0
    words[place[escapes] + 1] = flat[where[escapes]]
    return words, np.bincount(row, width, blocks).astype(np.int64), np.bincount(row, escapes, blocks) > 0


def _unpack_plain(words: np.ndarray, row: np.ndarray, counts: np.ndarray) -> np.ndarray:
    chosen = (words >> np.uint64(60)).astype(np.int64)
    n = COUNTS[chosen]
    place = np.cumsum(n) - n
    out = np.zeros(int(n.sum()), np.uint64)
    for s in range(2, 16):
        sel = chosen == s
        if sel.any():
            w, p = words[sel], place[sel]
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            for k in range(int(COUNTS[s])):
                out[p + k] = (w >> np.uint64(k * int(WIDTHS[s]))) & mask
    held = np.bincount(row, n, len(counts)).astype(np.int64)
    inside = np.arange(len(out)) - np.repeat(np.cumsum(held) - held, held)
    return out[inside < np.repeat(counts, held)]


def _unpack_escaped(words: list[int], count: int) -> np.ndarray:
    out: list[int] = []
    it = iter(words)
    for w in it:
        s = w >> 60
        if s == 0:
            out.append(next(it))
        else:
            out += [(w >> (k * int(WIDTHS[s]))) & ((1 << int(WIDTHS[s])) - 1) for k in range(int(COUNTS[s]))]
    return np.array(out[:count], np.uint64)


def unpack(words: np.ndarray, sizes: np.ndarray, counts: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks: their words, words per block, ids per block, escape flags."""
    if not escaped.any():
        return _unpack_plain(words, np.repeat(np.arange(len(sizes)), sizes), counts)
    ends = np.cumsum(sizes)
    parts = []
    for i, end in enumerate(ends):
        own = words[end - sizes[i] : end]
        if escaped[i]:
            parts.append(_unpack_escaped(own.tolist(), int(counts[i])))
        else:
            parts.append(_unpack_plain(own, np.zeros(len(own), np.int64), counts[i : i + 1]))
    return np.concatenate(parts)


class Writer:
    """One file: words as they come, then a footer with block and document sizes."""

    def __init__(self, out):
        self.out, self.rest = out, np.zeros(0, np.uint64)
        self.sizes: list[np.ndarray] = []
        self.flags: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.null: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        out.write(_MAGIC)

    def _blocks(self, ids: np.ndarray) -> None:
        words, sizes, flags = pack(ids)
        self.out.write(words.astype("<u8").tobytes())
        self.sizes.append(sizes)
        self.flags.append(flags)
        self.counts.append(np.minimum(BLOCK, len(ids) - BLOCK * np.arange(len(sizes))))

    def add(self, doc_ids: np.ndarray, null: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.null.append(null)
        self.lengths.append(lengths)
        ids = np.concatenate([self.rest, ids.astype(np.uint64)])
        whole = len(ids) // BLOCK * BLOCK
        if whole:
            self._blocks(ids[:whole])
        self.rest = ids[whole:]

    def close(self) -> int:
        if len(self.rest):
            self._blocks(self.rest)
        kinds = ((self.sizes, "<u2"), (self.counts, "<u2"), (self.flags, "u1"), (self.docs, "<i8"), (self.null, "u1"), (self.lengths, "<u8"))
        body = b"".join(struct.pack("<Q", len(x := (np.concatenate(p) if p else np.zeros(0)).astype(k).tobytes())) + x for p, k in kinds)
        body = zlib.compress(body, 1)
        self.out.write(body + struct.pack("<Q", len(body)) + _MAGIC)
        return int(sum(x.sum() for x in self.lengths))


class Reader:
    """Footer at once, ids by runs of blocks."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        source.seek(end - 16)
        tail = source.read(16)
        if tail[8:] != _MAGIC:
            raise ValueError("not a token file, or cut short")
        (n,) = struct.unpack("<Q", tail[:8])
        source.seek(end - 16 - n)
        body, at, found = zlib.decompress(source.read(n)), 0, []
        for kind in ("<u2", "<u2", "u1", "<i8", "u1", "<u8"):
            (size,) = struct.unpack_from("<Q", body, at)
            found.append(np.frombuffer(body, kind, size // np.dtype(kind).itemsize, at + 8))
            at += 8 + size
        self.sizes, self.counts = found[0].astype(np.int64), found[1].astype(np.int64)
        self.flags, self.docs, self.null, self.lengths = found[2].astype(bool), found[3], found[4].astype(bool), found[5].astype(np.int64)

    def ids(self, run: int = 512) -> Iterator[np.ndarray]:
        self.source.seek(len(_MAGIC))
        for a in range(0, len(self.sizes), run):
            sizes = self.sizes[a : a + run]
            words = np.frombuffer(self.source.read(int(sizes.sum()) * 8), "<u8").astype(np.uint64)
            yield unpack(words, sizes, self.counts[a : a + run], self.flags[a : a + run])

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, ids before it in this file, number of ids, crc32 of the ids as little-endian unsigned 32-bit integers."""
        runs, have, at, start = self.ids(), np.zeros(0, "<u4"), 0, 0
        for doc, null, n in zip(self.docs.tolist(), self.null.tolist(), self.lengths.tolist(), strict=True):
            crc, left = 0, n
            while left:
                if at == len(have):
                    have, at = next(runs).astype("<u4"), 0
                take = min(left, len(have) - at)
                crc = zlib.crc32(have[at : at + take].tobytes(), crc)
                at, left = at + take, left - take
            yield None if null else doc, start, n, crc
            start += n


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, on driver and executors alike."""
    return pafs.FileSystem.from_uri(uri)


def write_tokens(docs: DataFrame, uri: str, partitions: int | None = None, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> list[tuple[str, int, int]]:
    """Write all texts as token files in ascending doc_id order; return name, documents and ids of each file.

    A file is written under a temporary name and renamed when whole, so that a
    task that runs again, or twice, leaves the same file.
    """
    slim = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_column(docs).alias("text"))
    held = slim.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
    n = partitions or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held // FILE_BYTES))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        store, root = open_fs(uri)
        name = f"part-{TaskContext.get().partitionId():06d}.s8b"
        draft = f"{root}/.{name}-{uuid.uuid4().hex}"
        writer, out, rows = None, None, 0
        for batch in batches:
            for a, b, ids, counts in encoded(batch, vocabulary):
                if writer is None:
                    out = store.open_output_stream(draft)
                    writer = Writer(out)
                whole = np.insert(ids, np.cumsum(counts), end_id)
                key = batch.column("doc_id").slice(a, b - a)
                writer.add(key.fill_null(0).to_numpy(zero_copy_only=False), key.is_null().to_numpy(zero_copy_only=False), whole, counts + 1)
                rows += b - a
        if writer is not None:
            total = writer.close()
            out.close()
            store.move(draft, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"name": [name], "rows": pa.array([rows], pa.int64()), "ids": pa.array([total], pa.int64())})

    # Texts are dealt and encoded afterwards: encoded first, ids would have to be written as well, since the ranges are sampled.
    files = slim.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(write, "name string, rows bigint, ids bigint")
    return sorted(tuple(r) for r in files.collect())  # one row a file


def read_tokens(spark: SparkSession, uri: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    start, rows = 0, []
    for name, _, ids in files:
        rows.append((name, start))
        start += ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_fs(uri)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{root}/{name}") as source:
                    found: list[tuple] = []
                    for doc, at, n, crc in Reader(source).documents():
                        found.append((doc, base + at, n, crc))
                        if len(found) == 50_000:
                            yield _rows(found)
                            found = []
                    if found:
                        yield _rows(found)

    def _rows(found: list[tuple]) -> pa.RecordBatch:
        cols = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (
        spark.createDataFrame(rows, "name string, start bigint")
        .repartition(max(1, len(rows)))
        .mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, as read back from the token files."""
    uri = fresh_dir(spark, "tokens")
    files = write_tokens(documents(spark, sf_dir), uri)
    return read_tokens(spark, uri, files)
