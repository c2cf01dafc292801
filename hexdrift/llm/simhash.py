"""SimHash fingerprints, their bit-sliced comparison, and groups of near-duplicates.

Fingerprints are compared in blocks: the members of a block are stored as bit
planes, 64 members a machine word, and one member's distances to 64 others are
counted at once with carry-save counters. Words in which every distance has
passed the radius are abandoned after every eighth plane.

Blocks are found in one of two ways.

* ``fingerprint_groups`` links fingerprints at ``radius`` bits or fewer. Of the
  ``radius + 2`` fields a fingerprint is cut into, two are untouched in any such pair, so
  there is one table for each pair of fields. A block with too many members is
  cut again by the same rule in its remaining bits, after which at most 2^16
  different fingerprints can share a block. No link is lost.
* ``similar_groups`` links documents whose sets of word shingles have a Jaccard
  similarity of at least ``threshold``; at 0.8 fingerprints differ in up to some
  18 of 64 bits, too many for tables over fields. Blocks are documents that share the least shingle hash of
  one of eight strata (a pair at 0.8 misses all eight once in 390,000). Bit-sliced comparison at a wide radius
  says which members to compare first; a pair beyond it is ruled out only where the numbers of
  shingles in ``BINS`` bins differ by more than the threshold allows, which loses nothing. The rest
  are compared exactly on their shingle hashes. In blocks with more than ``MOST_ALIKE`` members, all are compared with
  a few leaders first. Those that link to the same leader need no comparison with each other; what is left meets all
  others where a second stratum agrees as well, in tiles if there are still too many. No task gets a whole large block.

Only one row stands for all copies of a fingerprint or shingle set. A block emits a
forest, not pairs. Components are joined by star contraction over written
tables; no link list reaches the driver.

Defined results: a null text is empty; texts without words have fingerprint zero
and form a group as any others do. Fewer words than a shingle count as one
shingle. Every row is a node of its own, whatever its doc_id: rows with a null or a repeated doc_id are linked by
their texts alone. A null doc_id ranks above all others, and a group of such rows only has a null
component_id. Of each group exactly one row stays, one of least doc_id. An empty input gives an empty result. Whole
texts are read; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, keep_rows, lean, row_key, text_column

SEED = 42
STRATA = 8
BINS = 64
MOST_MEMBERS = 4096
#: Members of a block compared in one task, and leaders of a larger one.
MOST_ALIKE, LEADERS = 4096, 3
_ONE = np.uint64(1)


# --- fingerprints ------------------------------------------------------------


def shingle_hashes(text: str, size: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of ASCII-lower-cased words, in runs of bounded length."""
    own = text.encode("utf-8", "replace").lower().split()
    if not own:
        return
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(own) - size + 1)
    last = ends[min(size, len(own)) - 1 :]
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, 65_536):
        pairs = zip(starts[a : min(n, a + 65_536)].tolist(), last[a : a + 65_536].tolist(), strict=False)
        yield np.array([digest(joined[i:j], SEED) for i, j in pairs], np.uint64)


def fingerprint(runs: list[np.ndarray]) -> int:
    """Bit i is set if it is in over half the hashes."""
    total = sum(map(len, runs))
    if not total:
        return 0
    counts = np.zeros(64, np.int64)
    for h in runs:
        for a in range(0, len(h), 8192):
            bits = np.unpackbits(h[a : a + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def _doc(df: DataFrame):
    return df["doc_id"].cast("bigint")


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """Rows (doc, fp): the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(list(shingle_hashes(t.as_py(), size))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc", "fp"])

    return docs.select(_doc(docs).alias("doc"), text_column(docs).alias("text")).mapInArrow(lean(run), "doc bigint, fp bigint")


# --- bit-sliced comparison ---------------------------------------------------


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes (64, words): bit m of word w of plane p is bit p of member 64 w + m."""
    words = -(-len(fps) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[: len(fps)] = fps
    lanes = padded.reshape(words, 64)
    out = np.empty((64, words), np.uint64)
    place = np.arange(64, dtype=np.uint64)
    for p in range(64):
        out[p] = np.bitwise_or.reduce((lanes >> np.uint64(p) & _ONE) << place, axis=1)
    return out


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry of three bits in every lane."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def within(planes: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int) -> np.ndarray:
    """For pairs of a query and a word of members: the members at ``radius`` bits or fewer, as a mask."""
    out = np.zeros(len(query), np.uint64)
    live = np.arange(len(query))
    count = [np.zeros(len(query), np.uint64) for _ in range(7)]  # bits of value 1, 2, 4, ... 64
    for p in range(0, 64, 8):
        x = [planes[k, word] ^ (np.uint64(0) - (query >> np.uint64(k) & _ONE)) for k in range(p, p + 8)]
        fours = []
        for k in (0, 4):
            count[0], low = _add(count[0], x[k], x[k + 1])
            count[0], high = _add(count[0], x[k + 2], x[k + 3])
            count[1], four = _add(count[1], low, high)
            fours.append(four)
        count[2], carry = _add(count[2], *fours)
        for d in range(3, 7):
            count[d], carry = count[d] ^ carry, count[d] & carry
        far = _far(count, radius)
        if p == 56:
            out[live] = ~far
            break
        on = far != ~np.uint64(0)
        if not on.all():
            live, query, word = live[on], query[on], word[on]
            count = [c[on] for c in count]
            if not len(live):
                break
    return out


def _far(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Mask of the lanes whose counter is above ``radius``."""
    above, equal = np.zeros_like(count[0]), np.full_like(count[0], ~np.uint64(0))
    for d in reversed(range(len(count))):
        if radius >> d & 1:
            equal &= count[d]
        else:
            above |= equal & count[d]
            equal &= ~count[d]
    return above


def links(fps: np.ndarray, sizes: np.ndarray, radius: int, chunk: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (i, j), i < j, inside blocks of the given sizes that lie one after the other in ``fps``."""
    words = -(-sizes // 64)
    first_word = np.cumsum(words) - words
    first = np.cumsum(sizes) - sizes
    slot = np.repeat(first_word * 64 - first, sizes) + np.arange(len(fps))
    padded = np.zeros(int(words.sum()) * 64, np.uint64)
    padded[slot] = fps
    used = np.zeros(len(padded), bool)
    used[slot] = True
    planes = planes_of(padded)
    valid = np.packbits(used.reshape(-1, 64), axis=1, bitorder="little").view("<u8").ravel()
    where = np.zeros(len(padded), np.int64)
    where[slot] = np.arange(len(fps))
    block = np.repeat(np.arange(len(sizes)), sizes)
    own = slot // 64  # members only look at their own word and later ones
    many = first_word[block] + words[block] - own
    after = np.cumsum(many)
    a = 0
    while a < len(fps):
        b = max(a + 1, int(np.searchsorted(after, (after[a - 1] if a else 0) + chunk, "right")))
        n = many[a:b]
        row = np.repeat(np.arange(a, b), n)
        word = own[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        mask = within(planes, fps[row], word, radius) & valid[word]
        hit = np.flatnonzero(mask)
        if len(hit):
            lanes = np.unpackbits(mask[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            h, lane = np.nonzero(lanes)
            i, j = row[hit[h]], where[word[hit[h]] * 64 + lane]
            on = i < j
            if on.any():
                yield i[on], j[on]
        a = b


class Forest:
    """Union by least index, in array steps."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            on = a != b
            i, j, a, b = i[on], j[on], a[on], b[on]
            if not len(i):
                return
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


# --- components --------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of an edge. Alternating star contraction."""
    edges = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = cut(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        new = cut(small.where("u <> v").distinct(), "edges")
        # Done when both steps change nothing: every edge then leads to its component.
        state = lambda t: t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state(new) == state(edges):
            return new.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        edges = new


def _masks(radius: int, bits: list[int]) -> list[int]:
    """One mask for each way to choose two untouched fields of radius + 2."""
    fields = [bits[len(bits) * i // (radius + 2) : len(bits) * (i + 1) // (radius + 2)] for i in range(radius + 2)]
    return [sum(1 << b for f in pick for b in f) for pick in combinations(fields, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _block_edges(members: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) of a forest in each row's block of parallel arrays ``node`` and ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp = (batch.column(c).flatten().to_numpy() for c in ("node", "fp"))
            sizes = batch.column("node").value_lengths().to_numpy().astype(np.int64)
            forest = Forest(len(node))
            for i, j in links(fp.view(np.uint64), sizes, radius):
                forest.join(i, j)
            on = np.flatnonzero(forest.root != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[on]), pa.array(node[forest.root[on]])], ["u", "v"])

    return members.mapInArrow(lean(run), "u bigint, v bigint")


def fingerprint_edges(nodes: DataFrame, radius: int, most: int = MOST_MEMBERS) -> DataFrame:
    """Edges between rows (node, fp) of distinct fingerprints at ``radius`` bits or fewer."""
    tables = _masks(radius, list(range(64)))
    key = F.struct(*[F.col("mask"), (F.col("fp").bitwiseAND(F.col("mask"))).alias("value")])
    spread = nodes.select("node", "fp", F.explode(F.array(*[F.lit(_signed(m)) for m in tables])).alias("mask")).select("node", "fp", key.alias("key"))
    sizes = cut(spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    shared = spread.join(sizes, "key")
    gather = lambda t: t.groupBy("key").agg(F.collect_list("node").alias("node"), F.collect_list("fp").alias("fp"))
    out = _block_edges(gather(shared.where(F.col("n") <= most)).select("node", "fp"), radius)
    if sizes.where(F.col("n") > most).isEmpty():
        return out
    # The other bits of a table are cut by the same rule; what remains is 16 bits or so, which bounds a block.
    finer = {m: [m | x for x in _masks(radius, [b for b in range(64) if not m >> b & 1])] for m in tables}
    lookup = F.create_map(*[y for m, own in finer.items() for y in (F.lit(_signed(m)), F.array(*[F.lit(_signed(x)) for x in own]))])
    hot = shared.where(F.col("n") > most).select("node", "fp", F.explode(lookup[F.col("key.mask")]).alias("mask")).select("node", "fp", key.alias("key")).distinct()
    hot = cut(hot, "hot")
    several = hot.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return out.unionByName(_block_edges(gather(hot.join(several, "key")).select("node", "fp"), radius))


def fingerprint_groups(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fp (signed) and component_id: the least doc_id that links of ``radius`` bits reach."""
    rows = cut(fingerprints(docs, size), "fingerprints")
    nodes = cut(rows.groupBy(F.col("fp").alias("node")).agg(F.min("doc").alias("least")), "nodes")
    found = components(fingerprint_edges(nodes.select("node", F.col("node").alias("fp")), radius))
    label = cut(nodes.join(found, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component")), "label")
    named = label.groupBy("component").agg(F.min("least").alias("component_id"))
    told = label.join(named, "component").select(F.col("node").alias("fp"), "component_id")
    return rows.join(told, "fp").select(F.col("doc").alias("doc_id"), "fp", "component_id")


# --- similarity of shingle sets ----------------------------------------------


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """Rows (row, doc, key, fp, same, least, size, bins, shingles): number and key of the row, fingerprint and identity of
    the shingle set, least hash of each stratum, the set by 32 bits of its hashes, how many these are, in all and in
    each bin (255 at most). The row's number holds once the table is written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in kinds]
            held = 0
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                runs = list(shingle_hashes(text.as_py(), size))
                unique = np.unique(np.concatenate(runs)) if runs else np.zeros(0, np.uint64)
                stratum = (unique >> np.uint64(7)) % np.uint64(STRATA)
                kind, first = np.unique(stratum, return_index=True)
                least: list = [None] * STRATA
                for s, at in zip(kind.tolist(), first.tolist(), strict=True):
                    least[s] = int(unique[at : at + 1].view(np.int64)[0])
                short = np.unique((unique >> np.uint64(32)).astype(np.uint32))
                bins = np.minimum(np.bincount(short % np.uint32(BINS), minlength=BINS), 255).astype(np.uint8).tobytes()
                raw = short.tobytes()
                same = xxhash.xxh3_128_digest(unique.tobytes())
                for col, x in zip(out, (doc, key, _signed(fingerprint([unique])), same, least, len(short), bins, raw), strict=True):
                    col.append(x)
                held += len(raw)
                if held > 1 << 22:
                    yield _rows(out)
                    out, held = [[] for _ in kinds], 0
            if out[0]:
                yield _rows(out)

    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary())

    def _rows(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc", "key", "fp", "same", "least", "size", "bins", "shingles"])

    slim = docs.select(_doc(docs).alias("doc"), row_key(docs).alias("key"), text_column(docs).alias("text"))
    rows = slim.mapInArrow(lean(run), "doc bigint, key binary, fp bigint, same binary, least array<bigint>, size int, bins binary, shingles binary")
    return rows.withColumn("row", F.monotonically_increasing_id())


def bins_of(raw: list[bytes]) -> np.ndarray:
    """Bins (members, BINS) of a block."""
    return np.frombuffer(b"".join(raw), np.uint8).reshape(-1, BINS)


def candidates(size: np.ndarray, bins: np.ndarray, threshold: float, wanted, chunk: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of a block that may reach the threshold, of those for which ``wanted(i, j)`` holds.

    Sets of a and b shingles reach it if at most (1 - t) / (1 + t) (a + b) shingles are in
    one of them only. Their bins differ by no more than that in sum, and neither set has
    fewer than t times the shingles of the other.
    """
    n = len(size)
    order = np.argsort(size, kind="stable")
    ranked = size[order]
    many = np.searchsorted(ranked, ranked / threshold + 1e-6, "right") - np.arange(n) - 1
    after = np.cumsum(many)
    low = np.uint64(0x00FF00FF00FF00FF)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(after, (after[a - 1] if a else 0) + chunk, "right")))
        row = np.repeat(np.arange(a, b), many[a:b])
        other = row + 1 + np.arange(len(row)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
        i, j = order[row], order[other]
        on = wanted(i, j)
        i, j = i[on], j[on]
        if len(i):
            x, y = bins[i], bins[j]
            gap = (np.maximum(x, y) - np.minimum(x, y)).view("<u8")
            lanes = ((gap & low) + (gap >> np.uint64(8) & low)).sum(axis=1)  # four sums of 16 bits each
            apart = np.zeros(len(i), np.int64)
            for d in range(0, 64, 16):
                apart += (lanes >> np.uint64(d) & np.uint64(0xFFFF)).astype(np.int64)
            on = apart * (1 + threshold) <= (1 - threshold) * (size[i] + size[j]) + 1e-6
            if on.any():
                yield i[on], j[on]
        a = b


def _verified(node: np.ndarray, fp: np.ndarray, bins: np.ndarray, sets: list[np.ndarray], threshold: float, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of one block: members whose sets reach the threshold, looked for among bit-sliced neighbours, then among all candidates."""
    n = len(node)
    forest = Forest(n)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    _, code = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(code, kind="stable")
    holder = owner[order]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(code))])
    begin = np.cumsum(size) - size
    apart = lambda i, j: forest.root[i] != forest.root[j]
    for pairs in (links(fp.view(np.uint64), np.array([n]), radius), candidates(size, bins, threshold, apart)):
        near: dict[int, list[np.ndarray]] = {}
        for i, j in pairs:
            cuts = np.flatnonzero(np.diff(i)) + 1
            for a, b in zip(np.split(i, cuts), np.split(j, cuts), strict=True):
                near.setdefault(int(a[0]), []).append(b)
        for i, parts in near.items():
            j = np.concatenate(parts)
            j = j[forest.root[j] != forest.root[i]]
            if not len(j):
                continue
            c = code[begin[i] : begin[i] + size[i]]
            if len(j) > 8:
                at = np.concatenate([holder[bounds[x] : bounds[x + 1]] for x in c.tolist()]) if len(c) else np.zeros(0, np.int64)
                shared = np.bincount(at, minlength=n)[j]
            else:
                shared = np.array([np.isin(code[begin[k] : begin[k] + size[k]], c).sum() for k in j.tolist()])
            whole = size[i] + size[j] - shared
            good = j[shared >= threshold * whole]
            forest.join(np.full(len(good), i), good)
    on = np.flatnonzero(forest.root != np.arange(n))
    return node[on], node[forest.root[on]]


def _in_blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[list]]:
    """Columns of each block of two rows or more; rows come sorted by their first column."""
    current, held = None, [[] for _ in range(width)]
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != current:
                if len(held[0]) > 1:
                    yield held
                current, held = row[0], [[] for _ in range(width)]
            for col, x in zip(held, row, strict=True):
                col.append(x)
    if len(held[0]) > 1:
        yield held


def _alike(blocks: DataFrame, threshold: float, radius: int) -> DataFrame:
    """Members (block, node) of blocks (block, node, fp, size, bins) that have another one within the radius or that may reach the threshold.

    A block is named after the members that are left, so that blocks in which the same ones are left become one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, node, fp, size, bins in _in_blocks(batches, 5):
            near = np.zeros(len(node), bool)
            for i, j in links(np.array(fp, np.int64).view(np.uint64), np.array([len(node)]), radius):
                near[i] = near[j] = True
            for i, j in candidates(np.array(size), bins_of(bins), threshold, lambda i, j, near=near: ~(near[i] & near[j])):
                near[i] = near[j] = True
            left = np.array(node, np.int64)[near]
            name = _signed(xxhash.xxh64_intdigest(left.tobytes(), SEED))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(left), name)), pa.array(left)], ["block", "node"])

    dealt = blocks.select("block", "node", "fp", "size", "bins").repartition("block").sortWithinPartitions("block", "node")
    return dealt.mapInArrow(lean(run), "block bigint, node bigint").distinct()


def _leader_edges(members: DataFrame, sets: DataFrame, threshold: float, most: int) -> DataFrame:
    """Edges (u, v) of the members (key, node) of large blocks that reach the threshold with a leader v of theirs.

    Leaders are the members of least hash, so that blocks which share most members share
    leaders, too. The members of a leader are dealt to as many parts as hold ``most`` of them each.
    """
    by_hash = F.struct(F.xxhash64("node", F.lit(7)).alias("h"), F.col("node"))
    leaders = members.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(LEADERS)).alias("part")).agg(F.min(by_hash).alias("l")).select("key", F.col("l.node").alias("leader"))
    pairs = cut(members.select("key", "node").join(leaders, "key").where("node <> leader").select("node", "leader").distinct(), "led")
    parts = cut(pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts")), "parts")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    led = pairs.join(parts, "leader").select("leader", part.alias("part"), "node").join(sets.select("node", "shingles"), "node")
    first = parts.join(sets.select(F.col("node").alias("leader"), "shingles"), "leader")
    first = first.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("bigint").alias("node"), "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint32)
        for batch in batches:
            u: list[int] = []
            v: list[int] = []
            for leader, node, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = np.frombuffer(raw, np.uint32)
                if node is None:
                    own = values
                    continue
                at = np.minimum(np.searchsorted(own, values), max(0, len(own) - 1))
                shared = int((own[at] == values).sum()) if len(own) else 0
                if shared >= threshold * (len(own) + len(values) - shared):
                    u.append(node)
                    v.append(leader)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    dealt = first.unionByName(led.select("leader", "part", "node", "shingles")).repartition("leader", "part")
    ordered = dealt.sortWithinPartitions("leader", "part", F.col("node").asc_nulls_first())
    return ordered.select("leader", "node", "shingles").mapInArrow(lean(run), "u bigint, v bigint")


def _rest(members: DataFrame) -> DataFrame:
    """Blocks (key, n, top, rest) of members (key, node, label) that not all have the commonest label: members, that label, how many have another or none."""
    kinds = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    top = F.max(F.when(F.col("label").isNotNull(), F.struct("n", "label"))).alias("top")
    told = kinds.groupBy("key").agg(F.sum("n").alias("n"), top)
    rest = F.col("n") - F.coalesce(F.col("top.n"), F.lit(0))
    return told.select("key", "n", F.col("top.label").alias("top"), rest.alias("rest")).where("n > 1 AND rest > 0")


def similar_edges(nodes: DataFrame, sets: DataFrame, threshold: float, radius: int, most: int = MOST_ALIKE) -> DataFrame:
    """Edges between rows (node, fp, least, size, bins) of different shingle sets at ``threshold`` or more; ``sets`` has (node, fp, bins, shingles)."""
    own = ["node", "fp", "size", "bins"]
    strata = F.transform(F.col("least"), lambda x, i: F.when(x.isNotNull(), F.struct(i.alias("i"), F.lit(-1).alias("k"), x.alias("x"), F.lit(0).cast("bigint").alias("y"))))
    keys = nodes.select("node", F.explode(F.filter(strata, lambda s: s.isNotNull())).alias("key"))
    # Joins that grow with the input are merge joins at every size, so that plans are the same for small and large ones.
    sizes = cut(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    placed = cut(keys.join(sizes.hint("merge"), "key"), "placed")
    blocks = placed.where(F.col("n") <= most).select("node", "key", F.lit(0).cast("bigint").alias("tile"))
    led = None
    if not sizes.where(F.col("n") > most).isEmpty():
        hot = placed.where(F.col("n") > most).select("node", "key")
        led = cut(_leader_edges(hot, sets, threshold, most), "stars")
        label = cut(led.unionByName(led.select(F.col("v").alias("u"), "v")).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label")), "labels")
        # Members with the commonest label of a block need no comparison with each other; blocks without others are done.
        named = cut(hot.select("node", "key").join(label, "node", "left"), "named")
        open_ = _rest(named).select("key")
        # Two members agree in one large block only (missed once in 12,000 at 0.8), or in two: where they agree in a small one they have met.
        several = named.join(open_, "key").groupBy("node", "label").agg(F.sort_array(F.collect_list("key")).alias("keys")).where("size(keys) > 1")  # at most STRATA
        pair = lambda x, y: F.struct(x["i"].alias("i"), y["i"].alias("k"), x["x"].alias("x"), y["x"].alias("y"))
        pairs = F.flatten(F.transform(F.col("keys"), lambda x, at: F.transform(F.filter(F.col("keys"), lambda y, to: to > at), lambda y: pair(x, y))))
        finer = cut(several.select("node", "label", F.explode(pairs).alias("key")), "finer")
        seen = cut(_rest(finer), "rest")
        sized = finer.join(seen, "key").select("node", "key", "n", "rest", (~F.col("label").eqNullSafe(F.col("top"))).alias("odd"))
        small = sized.where(F.col("n") <= most).select("node", "key", F.lit(0).cast("bigint").alias("tile"))
        # Of what is too large, the rest and all are dealt to tiles, and each tile of the rest meets each of all.
        large = sized.where(F.col("n") > most).withColumn("g", F.ceil(F.col("n") * 2 / most).cast("bigint")).withColumn("r", F.ceil(F.col("rest") * 2 / most).cast("bigint"))
        spot = lambda salt, parts: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(parts))
        upto = lambda parts: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1))
        met = large.select("node", "key", "g", upto("r").alias("a"), spot(1, "g").alias("b")).unionByName(
            large.where("odd").select("node", "key", "g", spot(2, "r").alias("a"), upto("g").alias("b"))
        )
        tiled = met.select("node", "key", (F.col("a") * F.col("g") + F.col("b") + 1).alias("tile")).distinct()
        blocks = blocks.unionByName(small).unionByName(tiled)
    blocks = blocks.select("node", F.xxhash64("key", "tile").alias("block")).join(nodes.select(*own).hint("merge"), "node")
    members = cut(_alike(blocks, threshold, radius), "alike")
    loaded = members.hint("merge").join(sets.select("node", "fp", "bins", "shingles"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, node, fp, bins, raw in _in_blocks(batches, 5):
            shingles = [np.frombuffer(x, np.uint32) for x in raw]
            u, v = _verified(np.array(node, np.int64), np.array(fp, np.int64), bins_of(bins), shingles, threshold, radius)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    grouped = loaded.select("block", "node", "fp", "bins", "shingles").repartition("block").sortWithinPartitions("block", "node")
    edges = grouped.mapInArrow(lean(run), "u bigint, v bigint")
    return edges if led is None else edges.unionByName(led)


def _similar(docs: DataFrame, size: int, threshold: float, radius: int) -> tuple[DataFrame, DataFrame]:
    """The written rows of ``sketches``, and for each shingle set (same, node, top, component): its least row, its row of least doc_id and its component."""
    rows = cut(sketches(docs, size), "sketches")
    top = F.min(F.struct(F.col("doc").isNull().alias("null"), "doc", "row"))
    classes = cut(rows.groupBy("same").agg(F.min("row").alias("node"), top.alias("top")), "classes")
    nodes = cut(rows.select(F.col("row").alias("node"), "fp", "least", "size", "bins").join(classes.select("node").hint("merge"), "node"), "nodes")
    sets = rows.select(F.col("row").alias("node"), "fp", "bins", "shingles")
    found = components(similar_edges(nodes, sets, threshold, radius))
    label = classes.join(found, "node", "left").select("same", "node", "top", F.coalesce("component", "node").alias("component"))
    return rows, cut(label, "label")


def similar_groups(docs: DataFrame, size: int = 5, threshold: float = 0.8, radius: int = 20) -> DataFrame:
    """(doc_id, component_id) of each row: the least doc_id that links of that similarity reach."""
    rows, label = _similar(docs, size, threshold, radius)
    named = label.groupBy("component").agg(F.min("top").alias("top"))
    told = label.join(named.select("component", F.col("top.doc").alias("component_id")), "component").select("same", "component_id")
    return rows.select("doc", "same").join(told, "same").select(F.col("doc").alias("doc_id"), "component_id")


def one_of_each(docs: DataFrame, size: int = 5, threshold: float = 0.8, radius: int = 20) -> DataFrame:
    """One row of each group of ``docs``, one of least doc_id, with all columns."""
    rows, label = _similar(docs, size, threshold, radius)
    stays = label.groupBy("component").agg(F.min("top").alias("top")).select(F.col("top.row").alias("row"), F.lit(1).alias("stays"))
    told = rows.select("row", "key").join(stays, "row", "left").select("key", F.coalesce("stays", F.lit(0)).alias("keep"))
    return keep_rows(docs, told)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    rows = fingerprint_groups(documents(spark, sf_dir), 3, 2)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
