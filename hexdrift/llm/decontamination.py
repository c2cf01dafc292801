"""Benchmark decontamination under edit distance.

A document is contaminated by an item of n words if one of its windows of n words is at
word edit distance ``(1 - similarity) n`` or less; a document of fewer words is one window.
Windows and items are embedded by CGK random walks, which turn edit distance into Hamming
distance: a walk emits the word it stands at and moves on if a random bit of step and word says
so, over 3 n steps. Half of the walks start at the window's end, so that edits gathered at
one side leave the other side's walks alone. Sampled steps of the first 2 n form the keys of
several locality-sensitive hash tables (what comes later is mostly beyond the end), and
what shares a key is verified by exact edit distance. ``WALKS``, ``TABLES`` and ``SAMPLES`` are such that
at the allowed distance itself at least 95 of 100 windows are found, wherever the edits lie; the tests measure it
by brute force for items of 10 to 130 words.

Before any walk, windows are ruled out that contain too few word pairs of the
benchmark: an edit touches two pairs at most, so a window within k edits of an item
of n words has n - 1 - 2 k of its pairs, and n - k of its words, at least. Nor do windows count that
repeat a few words over and over: an edit takes away one kind of word at most.
Before exact verification words are compared as multisets. None of this loses
anything.

The benchmark is the stated query set. It is read in blocks of at most ``BLOCK_ITEMS`` items and
about ``BLOCK_WORDS`` words. A single block is broadcast once; of several, each is searched for and
its broadcast destroyed before the next is read, so that memory is bounded whatever the benchmark's size.

Defined results: null and empty texts match nothing, and items without words are
not looked for. Equal items are all reported. ``contamination`` reports repeated documents
once for each doc_id, a null doc_id as null; ``uncontaminated`` decides on every row by its own text,
whatever its doc_id. An empty input or benchmark gives an empty result or drops nothing. Texts of any
length are read whole. Other columns are not looked at and kept as they are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import cut, documents, lean, slices, text_column, words

SIMILARITY = 0.8
WALKS, TABLES, SAMPLES = 8, 14, 3
BLOCK_ITEMS, BLOCK_WORDS = 10_000, 2_000_000
#: Sizes up to this times the least one are walked together.
SPREAD = 1.25
NEAR = 6
MARKS = 1 << 20
#: Windows walked together.
RUN = 1 << 17
#: Bytes of text looked at together.
PIECE = 1_500_000


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Levenshtein distance of two sequences, or most + 1 if it is more."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    place = np.arange(m + 1)
    row = place.copy()
    for i in range(1, n + 1):
        step = np.minimum(row[:-1] + (b != a[i - 1]), row[1:] + 1)
        step = np.concatenate([[i], step])
        row = np.minimum.accumulate(step - place) + place
        if row.min() > most:
            return most + 1
    return int(min(row[-1], most + 1))


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A hash of words (small integers) and a salt."""
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


class Block:
    """A block of items, ready to be searched for."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, walks: int, samples: int):
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        for item, text in items:
            own = words(text)
            if own:
                self.items.append((item, np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in own])))
        self.walks, self.samples = walks, samples
        self.by_size: dict[int, list[int]] = {}
        for i, (_, seq) in enumerate(self.items):
            self.by_size.setdefault(len(seq), []).append(i)
        self.bags = [Counter(seq.tolist()) for _, seq in self.items]
        #: By size: the least number of different words of an item.
        self.kinds = {n: min(len(self.bags[i]) for i in own) for n, own in self.by_size.items()}
        self.width = len(self.vocabulary) + 1
        pairs = [seq[:-1] * self.width + seq[1:] for _, seq in self.items]
        self.grams = np.unique(np.concatenate([np.array([-1]), *pairs]))
        self.allowed = {n: int((1 - similarity) * n + 1e-9) for n in self.by_size}
        #: Groups of sizes that are walked together, by the least one.
        self.groups: dict[int, list[int]] = {}
        for n in sorted(self.by_size):
            low = next(reversed(self.groups), None)
            self.groups.setdefault(low if low and n <= SPREAD * low else n, []).append(n)
        steps = 3 * max(self.by_size, default=1)
        #: In walk r, step j: a word moves the walk on if its bit is set.
        codes = np.arange(len(self.vocabulary) + 1)
        self.moves = [[(_mix(codes, r * steps + j) & np.uint64(1)).astype(np.int8) for j in range(steps)] for r in range(walks)]
        self.tables: dict[int, dict[int, list[int]]] = {}
        for low, sizes in self.groups.items():
            own = [i for n in sizes for i in self.by_size[n]]
            size = np.array([len(self.items[i][1]) for i in own])
            table: dict[int, set[int]] = {}
            for key in self.keys(np.concatenate([self.items[i][1] for i in own]), np.cumsum(size) - size, size, size, low):
                for i, k in zip(own, key.tolist(), strict=True):
                    table.setdefault(k, set()).add(i)
            self.tables[low] = {k: sorted(v) for k, v in table.items()}
        self.sorted_keys = {n: np.array(sorted(t), np.uint64) for n, t in self.tables.items()}
        #: By group: which values the low bits of its keys have, so that few are looked up.
        self.marks = {n: np.bincount((k & np.uint64(MARKS - 1)).astype(np.int64), minlength=MARKS) > 0 for n, k in self.sorted_keys.items()}

    def keys(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray, size: np.ndarray, low: int) -> Iterator[np.ndarray]:
        """The hash keys of windows of ``length`` words at ``start``, one array a table; a key holds the item's size, too."""
        last = start + length - 1
        for r in range(self.walks):
            rng = np.random.default_rng([low, r])
            tables = [np.sort(rng.choice(2 * low, min(self.samples, 2 * low), replace=False)) for _ in range(TABLES)]
            wanted = set(np.concatenate(tables).tolist())
            back = r % 2 == 1
            at = last.copy() if back else start.copy()
            seen = {}
            for j in range(max(wanted) + 1):
                inside = at >= start if back else at <= last
                word = np.where(inside, codes[np.clip(at, start, last)], 0)
                if j in wanted:
                    seen[j] = word
                step = self.moves[r][j][word]
                at += -step if back else step
            for t, picks in enumerate(tables):
                key = _mix(size, TABLES * r + t)
                for j in picks.tolist():
                    key = _mix(key ^ seen[j].astype(np.uint64), 13)
                yield key

    def search(self, codes: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
        """By document and item index: least distance over the windows, and the word where it is first reached.

        ``codes`` has the words of several documents in a row, ``ends`` where each of them ends.
        """
        found: dict[tuple[int, int], tuple[int, int]] = {}
        grams = codes[:-1] * self.width + codes[1:]
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = np.concatenate([[0], np.cumsum((self.grams[at] == grams) & (codes[:-1] > 0) & (codes[1:] > 0), dtype=np.int32)])
        # Words other than the NEAR before them; at most NEAR more of a window's words can be its first of a kind.
        fresh = np.ones(len(codes), bool)
        for b in range(1, NEAR + 1):
            fresh[b:] &= codes[b:] != codes[:-b]
        kinds = np.concatenate([[0], np.cumsum(fresh, dtype=np.int32)])
        member = np.concatenate([[0], np.cumsum(codes > 0, dtype=np.int32)])
        room = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(codes))  # words left in the document
        owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        begin = ends - np.diff(ends, prepend=0)
        held = ends - begin
        for low, sizes in self.groups.items():
            starts, widths, lengths = [], [], []
            # What is poor over the widest window of a group is poor over all of its windows.
            top = min(sizes[-1], len(codes))
            until = np.minimum(np.arange(len(codes)) + top - 1, len(codes) - 1)
            least = min(n - 1 - 2 * self.allowed[n] for n in sizes)
            maybe = np.flatnonzero(known[until] - known >= least) if len(codes) else np.zeros(0, np.int64)
            for n in sizes:
                own = maybe[room[maybe] >= n]
                own = own[known[own + n - 1] - known[own] >= n - 1 - 2 * self.allowed[n]]
                own = own[member[own + n] - member[own] >= n - self.allowed[n]]
                own = own[kinds[own + n] - kinds[own] + NEAR >= self.kinds[n] - self.allowed[n]]
                short = np.flatnonzero((held < n) & (held >= max(1, n - self.allowed[n])))
                short = short[known[ends[short] - 1] - known[begin[short]] >= n - 1 - 2 * self.allowed[n]]
                starts += [own, begin[short]]
                widths += [np.full(len(own), n), held[short]]
                lengths.append(np.full(len(own) + len(short), n))
            start, width, size = np.concatenate(starts), np.concatenate(widths), np.concatenate(lengths)
            table, listed, marks = self.tables[low], self.sorted_keys[low], self.marks[low]
            for a in range(0, len(start), RUN):
                own, wide, n = start[a : a + RUN], width[a : a + RUN], size[a : a + RUN]
                pairs: set[tuple[int, int, int, int]] = set()
                for key in self.keys(codes, own, wide, n, low):
                    some = np.flatnonzero(marks[(key & np.uint64(MARKS - 1)).astype(np.int64)])
                    at = np.minimum(np.searchsorted(listed, key[some]), len(listed) - 1)
                    for k in some[listed[at] == key[some]].tolist():
                        s = int(own[k])
                        pairs.update((int(owner[s]), i, s, int(wide[k])) for i in table[int(key[k])])
                for doc, i, s, m in sorted(pairs):
                    seq, bag = self.items[i][1], self.bags[i]
                    limit = self.allowed[len(seq)]
                    best = found.get((doc, i))
                    if best is not None:
                        limit = min(limit, best[0])
                    window = codes[s : s + m]
                    if (Counter(window.tolist()) & bag).total() < len(seq) - limit:
                        continue
                    d = edit_distance(seq, window, limit)
                    if d <= limit and (best is None or (d, s) < best):
                        found[doc, i] = (d, s)
        return found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; one empty block if there are none."""
    block: list[tuple[int, str]] = []
    held = n = 0
    for row in benchmark.select(benchmark["item_id"].cast("bigint").alias("item_id"), text_column(benchmark).alias("text")).toLocalIterator():
        size = len(words(row[1]))
        if block and (len(block) == BLOCK_ITEMS or held + size > BLOCK_WORDS):
            yield block
            block, held, n = [], 0, n + 1
        block.append((row[0], row[1]))
        held += size
    if block or not n:
        yield block


def _searched(sent, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, distance, words, first word) of everything found in a batch of texts."""
    own = sent.value
    code = own.vocabulary.get
    for a, b in slices((len(t.as_py()) for t in texts), PIECE):
        codes, ends = [], []
        for t in texts.slice(a, b - a):
            codes += [code(w, 0) for w in words(t.as_py())]
            ends.append(len(codes))
        if not codes:
            continue
        bounds = np.array([0, *ends])
        for (k, i), (d, s) in own.search(np.array(codes, np.int64), bounds[1:]).items():
            item, seq = own.items[i]
            yield a + k, item, d, len(seq), s - int(bounds[k])


def _by_block(benchmark: DataFrame, similarity: float, walks: int, samples: int, look, name: str, carry: bool) -> DataFrame | None:
    """``look(block, frame)`` of every block; frames of several blocks are written one after the other."""
    spark = benchmark.sparkSession
    blocks = _blocks(benchmark)
    block = next(blocks)
    found: list[DataFrame] = []
    while block is not None:
        then = next(blocks, None)
        sent = spark.sparkContext.broadcast(Block(block, similarity, walks, samples))
        frame = look(sent, found[-1] if carry and found else None)
        if then is None and not found:
            return frame
        found.append(cut(frame, name))
        sent.destroy()
        block = then
    out = found[-1] if carry else found[0]
    for f in [] if carry else found[1:]:
        out = out.unionByName(f)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, walks: int = WALKS, samples: int = SAMPLES) -> DataFrame:
    """A row for each document and item found in it: doc_id, item_id, distance, n_words, first_word, similarity."""
    slim = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_column(docs).alias("text"))
    schema = "doc_id bigint, item_id bigint, distance int, n_words int, first_word bigint"

    def look(sent, _) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[k], item, d, n, s) for k, item, d, n, s in _searched(sent, batch.column(1))]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                cols = zip(*rows, strict=True) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "distance", "n_words", "first_word"])

        return slim.mapInArrow(lean(run), schema)

    hits = _by_block(benchmark, similarity, walks, samples, look, "contaminated", False)
    best = hits.groupBy("doc_id", "item_id", "n_words").agg(F.min(F.struct("distance", "first_word")).alias("b"))
    return best.select(
        "doc_id",
        "item_id",
        "n_words",
        F.col("b.distance").alias("distance"),
        F.col("b.first_word").alias("first_word"),
        (1 - F.col("b.distance") / F.col("n_words")).alias("similarity"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    names = docs.columns

    def look(sent, kept: DataFrame | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for k, *_ in _searched(sent, batch.column(0)):
                    clean[k] = False
                yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(clean))], ["row"])

        frame = docs if kept is None else kept
        packed = frame.select(text_column(frame).alias("text"), F.struct(*[frame[f"`{c}`"] for c in names]).alias("row"))
        rows = packed.mapInArrow(lean(run), StructType([packed.schema["row"]]))
        return rows.select(*[F.col("row").getField(c).alias(c) for c in names])

    return _by_block(benchmark, similarity, WALKS, SAMPLES, look, "clean", True)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document."""
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
