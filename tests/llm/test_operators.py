"""The corpus operators against brute force, on edge cases and on the small table."""

import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import same_rows

from hexdrift.llm import decontamination, exact_dedup, hilbert_shards, licenses, line_dedup, packing, queries, simhash, tokens, toxicity, warc
from hexdrift.llm.common import cut, fresh_dir, lean, words

LONG = "long text with many words and lines\n" * 9000
TEXTS = [None, "", "a", "A", "  ", "same words here", "same words here", "same words here", LONG, "é ÀÇ <|endoftext|> don't 42", "x" * 50_000, "one two three\nfour five six\n", None]
SCHEMA = "doc_id long, text string, lang string, source string, digest string, row_id int, _n int, rank int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns whose names clash."""
    rows = [(i, t, "en", None if i % 2 else "s", "d", i, i, i) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[8], (None, "no id", None, "s", None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(duck):
    return duck.sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, duck, data, name):
    same_rows(queries.QUERIES[name](spark, data), duck.sql(queries.ORACLES[name]))


def test_exact_dedup_edges(odd, none):
    rows = exact_dedup.dedup_batch(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(bytes(r.digest), []).append(r)
    for group in by.values():
        assert sum(r.kept for r in group) == 1 and all(r.group_size == len(group) for r in group)
    assert sorted(exact_dedup.keep_first(odd).columns) == sorted(odd.columns)
    assert exact_dedup.keep_first(odd).count() == len(by)
    assert exact_dedup.dedup_batch(none).count() == 0


def test_digest_index_grows(spark, odd):
    index = exact_dedup.DigestIndex(spark, "digest_index_test", 4)
    index.drop()
    first = {(r.doc_id, r.keep_id, r.kept) for r in index.ingest(odd).collect()}
    assert {(r.doc_id, r.keep_id, r.kept) for r in index.ingest(odd).collect()} == first  # a batch may come again
    more = spark.createDataFrame([(100, "same words here"), (101, "new")], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in index.ingest(more, "second").collect()} == {(100, 7, False), (101, 101, True)}
    again = spark.createDataFrame([(None, "no id"), (7, "same words here"), (None, None)], "doc_id long, text string")
    assert [r.kept for r in index.ingest(again, "third").collect()] == [False] * 3  # other batches hold these texts
    index.compact()
    held = index.read().count()
    assert held == len({r.keep_id for r in index.ingest(odd).collect()}) + 1
    spark.sql("ALTER TABLE digest_index_test RENAME TO digest_index_test_next")  # a crash before the last step of compact
    assert index.read().count() == held and index._buckets(0) == 4
    index.drop()


def _line_dedup(rows):
    keyed = [(d, t, [x.strip(" \t\n\v\f\r").translate({i: i + 32 for i in range(65, 91)}) for x in t.split("\n")]) for d, t in rows]
    holders = {}
    for d, _, keys in keyed:
        for k in keys:
            if len(k) >= 20:
                holders.setdefault(k, set()).add(d)
    out = []
    for d, t, keys in keyed:
        lines = t.split("\n")
        kept = [x for x, k in zip(lines, keys) if len(holders.get(k, ())) < 3 or d == max(holders[k])]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("bits", [1 << 28, 64])
def test_line_dedup(spark, none, bits):
    rnd = random.Random(2)
    pool = ["A line that is long enough to count", " a LINE that is long enough to count\t", "short", "ünïcode lïne of twenty +", "", "x" * 19, "y" * 20]
    rows = [(i, "\n".join(rnd.choices(pool, k=rnd.randrange(0, 6)))) for i in range(60)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), most_bits=bits).collect()
    assert sorted(tuple(r) for r in got) == _line_dedup(rows)
    assert line_dedup.line_dedup(none).count() == 0


def test_line_dedup_edges(spark, odd):
    assert line_dedup.line_dedup(odd).count() == odd.count()
    line = "a line of twenty characters or more"
    rows = [(None, line), (None, line), (1, f"{line}\nx"), (2, line.upper() + "\t"), (2, line.upper() + "\t"), (3, "alone " + line)]
    got = line_dedup.line_dedup(spark.createDataFrame([(*r, "z", 5) for r in rows], "doc_id long, text string, doc string, n_lines int")).collect()
    want = [(None, 1, 1, ""), (None, 1, 1, ""), (1, 2, 1, "x"), (2, 1, 0, rows[3][1]), (2, 1, 0, rows[3][1]), (3, 1, 0, rows[5][1])]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("high", [2, 50_000, 1 << 31, 1 << 60, 1 << 63])
def test_simple8b_round_trip(high):
    rng = np.random.default_rng(high)
    for n in (0, 1, 1023, 1024, 1025, 9000):
        ids = rng.integers(0, high, n, dtype=np.uint64)
        ids[rng.random(n) < 0.5] = 0
        words_, sizes, escaped = tokens.pack(ids)
        counts = np.minimum(tokens.BLOCK, n - tokens.BLOCK * np.arange(len(sizes)))
        assert n == 0 or (tokens.unpack(words_, sizes, counts, escaped) == ids).all()


def _ids(text, end):
    e = tokens.encoder()
    return np.array([*e.tokenizer.encode(text, add_special_tokens=False).ids, end], "<u4")


def _check_tokens(rows, got):
    at = 0
    for (doc, text), r in zip(rows, sorted(got, key=lambda r: r.start), strict=True):
        ids = _ids(text, 1)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files(spark, data, docs):
    _check_tokens(docs, tokens.op3_token_files(spark, data).collect())


def test_token_files_edges(spark, odd, none):
    uri = fresh_dir(spark, "test-tokens")
    got = tokens.read_tokens(spark, uri, tokens.write_tokens(odd, uri)).collect()
    assert len(got) == odd.count() and sum(r.n_tokens for r in got if r.doc_id in (0, 1, 12)) == 3
    empty = fresh_dir(spark, "test-tokens")
    assert tokens.read_tokens(spark, empty, tokens.write_tokens(none, empty)).count() == 0


def test_encoder_equals_tokenizer():
    e = tokens.Encoder(tokens.VOCABULARY)
    odd = ["Don't we'll I'M", "İstanbul ŉa ß ﬁ ½ x²", "<|startoftext|>a<|endoftext|> b", "á é.", "a b c", "1,234.5 a.b,c ...", "日本語 テキスト", "\x1c\x85x", "🙂 ok🙂", ""]
    ids, counts = e.encode(odd)
    at = 0
    for text, n in zip(odd, counts, strict=True):
        assert ids[at : at + n].tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, text
        at += n


@pytest.mark.parametrize("seed", range(20))
def test_packing_plan(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 200))
    lengths = Counter(rng.integers(1, capacity + 1, int(rng.integers(0, 400))).tolist())
    bins, ranks = {}, {}
    for n, rank, count, each, first, offset in packing.plan(lengths, capacity):
        ranks.setdefault(n, []).extend(range(rank, rank + count))
        for r in range(count):
            bins.setdefault(first + r // each, []).append((offset + n * (r % each), n))
    assert all(sorted(ranks[n]) == list(range(c)) for n, c in lengths.items())
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= capacity and sum(3 * n > capacity for _, n in held) <= 2


def test_packing(spark, odd, none):
    rows = [(r.doc_id, r.text or "") for r in odd.collect()]
    got = packing.pack(odd).collect()
    assert sum(r.length for r in got) == sum(len(_ids(t, 0)) for _, t in rows)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048
    long = _ids(LONG, 0)
    mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == 8)
    assert mine == sorted([(p, s, len(long[s : s + 2048]), zlib.crc32(long[s : s + 2048].tobytes())) for p, s in enumerate(range(0, len(long), 2048))] * 2)
    assert packing.pack(none).count() == 0


def test_licenses(spark, none):
    filler = "lorem ipsum dolor sit amet consectetur"
    rows = [(1, f"{filler} Released under the MIT license {filler}"), (2, filler), (3, None), (4, ""), (5, "MIT"), (6, f"{filler}\nThis work is licensed under the GNU general public licence, version 3!")]
    got = {(r.doc_id, r.license_id) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "MIT"), (6, "GPL-3.0")}
    assert licenses.scan(none).count() == 0


def test_license_edges(spark, odd):
    """Whole licences, null and repeated rows, very long texts, clashing columns, a table of templates."""
    two, three = (next(t for n, t in licenses.TEMPLATES if n == x) for x in ("BSD-2-Clause", "BSD-3-Clause"))
    long = "filler words here " * 40_000
    mit = "Released under the MIT License. "
    rows = [(1, two, 1), (2, three, 2), (None, mit, 3), (None, mit, 4), (5, long + mit + long, 5), (5, mit, 6), (5, mit, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, dice int")
    got = Counter((r.doc_id, r.license_id) for r in licenses.scan(docs).collect())
    assert got == Counter({(1, "BSD-2-Clause"): 1, (2, "BSD-3-Clause"): 1, (None, "MIT"): 2, (5, "MIT"): 3})
    own = spark.createDataFrame([("own", "same words here"), ("none", None)], "license_id string, text string")
    assert {r.license_id for r in licenses.scan(odd, own).collect()} == {"own"}


def test_license_scan_is_exhaustive(docs):
    """Every place is compared, without the bounds."""
    own = licenses.Templates(licenses.TEMPLATES, licenses.THRESHOLD)
    for _, text in [x for x in docs if len(x[1]) < 4000]:
        split = words(text)
        codes = np.array([own.code.get(w, 0) for w in split], np.int64)
        found = {own.names[t] for t, *_ in own.scan(codes)} if len(codes) > 1 else set()
        best = {}
        for t, bag in enumerate(own.bags):
            n = min(int(own.sizes[t]), len(codes) - 1)
            for s in range(max(0, len(codes) - n)):
                w = [(a, b) if a and b else (-1, i) for i, (a, b) in enumerate(zip(codes[s : s + n], codes[s + 1 : s + n + 1]))]
                best[t] = max(best.get(t, 0), licenses.dice(Counter((int(a), int(b)) for a, b in w), bag)) if n > 0 else 0
        every = {own.names[t] for t, d in best.items() if d >= licenses.THRESHOLD}
        assert found <= every and bool(found) == bool(every)
        if len(every) == 1:
            assert found == every


def test_warc(spark):
    rows = [(3, "http://a b", "same"), (1, None, "same"), (2, "u", None), (5, "u", ""), (4, "u", "é" * 100_000), (1, None, "same"), (None, "u", "same")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, offset int")
    uri = fresh_dir(spark, "test-warc")
    index = warc.write_archives(pages, uri)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_records(index, uri).collect()), key=repr)
    d = lambda t: warc.digest32(t.encode())
    want = [(3, 4, d("same"), "revisit", 1), (1, 4, d("same"), "response", None), (1, 4, d("same"), "revisit", 1), (None, 4, d("same"), "revisit", 1), (2, 0, d(""), "response", None), (5, 0, d(""), "revisit", 2), (4, 200_000, d("é" * 100_000), "response", None)]
    assert got == sorted(want, key=repr)
    last = (1 << 63) - 1  # a null page_id is no other's
    ends = spark.createDataFrame([(last, "u", "tie"), (None, "u", "tie"), (None, None, None)], "page_id long, url string, html string")
    again = fresh_dir(spark, "test-warc")
    told = [(r.page_id, r.record_type, r.refers_to) for r in warc.read_records(warc.write_archives(ends, again), again).collect()]
    assert sorted(told, key=repr) == sorted([(last, "response", None), (None, "revisit", last), (None, "response", None)], key=repr)
    only = warc.read_records(index.where("page_id = 4"), uri).collect()
    assert [bytes(r.body).decode() for r in only] == ["é" * 100_000]
    empty = fresh_dir(spark, "test-warc")
    assert warc.read_records(warc.write_archives(pages.where("false"), empty), empty).count() == 0


def test_toxicity_learns(spark, none):
    rnd = random.Random(4)
    plain = ["".join(rnd.choices("abcdefghij", k=rnd.randrange(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        own = rnd.choices(plain, k=60) + (rnd.choices(["vilestuff", "vilestuffer", "nastyword"], k=5) if toxic else [])
        rnd.shuffle(own)
        rows.append((i, " ".join(own)))
        labels.append((i, 1, int(toxic)))
    rows += [(2000, None), (2001, ""), (None, "text"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marked)
    got = toxicity.score(docs, model, ["doc_id"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = {r.row.doc_id: r.score for r in got if r.row.doc_id is not None and r.row.doc_id < 900 and zlib.crc32(str(r.row.doc_id).encode()) % 3 == 1}
    right = sum((s >= toxicity.THRESHOLD) == (i % 5 == 0) for i, s in held.items())
    assert right / len(held) > 0.95
    kept = toxicity.ordinary(docs, marked)
    assert kept.columns == ["doc_id", "text"] and 650 < kept.count() < 800
    assert toxicity.score(none, model, ["doc_id"]).count() == 0
    assert toxicity.fit(docs, marked.where("false")).score(0.0) < 0.01


def test_toxicity_keeps_the_class_ratio(spark):
    """Labels that no text explains: a score is the share of toxic rows, however few rows of a class are drawn."""
    rnd = random.Random(11)
    docs = spark.createDataFrame([(i, " ".join(rnd.choices("abcdefghij", k=12))) for i in range(3000)], "doc_id long, text string")
    marked = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(3000)], "doc_id long, toxic int")
    scores = [r.score for r in toxicity.score(docs, toxicity.fit(docs, marked, 200), []).collect()]
    assert 0.05 < sum(scores) / len(scores) < 0.2


def _toxicity_ratios(rows):
    """The two models by their definition, over dictionaries."""
    seen = set()
    for text, c in rows:
        own = ["", "", *[w.decode() for w in words(text)]]
        seen |= {(c, *x) for x in zip(own, own[1:], own[2:])}
    pair, before, contexts, kinds = Counter(), Counter(), Counter(), Counter()
    for c, _, h, w in seen:
        pair[c, h, w] += 1
        contexts[c, w] += 1
    for c, _, w in pair:
        before[c, w] += 1
    for _, w in {(h, w) for _, h, w in pair}:
        kinds[w] += 1
    d, word, other, v = toxicity.DISCOUNT, toxicity.WORD, toxicity.PAIR, len(kinds)
    every = [sum(n for (c, _), n in before.items() if c == k) for k in (0, 1)]
    own = [sum(c == k for c, _ in before) for k in (0, 1)]
    shared = {w: (max(n - d, 0) + d * v / (v + 1)) / sum(kinds.values()) for w, n in kinds.items()}
    p = {w: [(max(before[c, w] - d, 0) + (d * own[c] + word) * shared[w]) / (every[c] + word) for c in (0, 1)] for w in kinds}
    ratio = {w: np.log(x[1] / x[0]) for w, x in p.items()}
    ratio = {w: x for w, x in ratio.items() if abs(x) >= toxicity.NEUTRAL}
    pairs = {}
    for h, w in {(h, w) for _, h, w in pair if h}:
        n = [pair[c, h, w] for c in (0, 1)]
        t = [contexts[c, h] for c in (0, 1)]
        if max(n) >= toxicity.CONTEXTS:
            q = [(max(n[c] - d, 0) + (d * before[c, h] + other) * sum(n) / sum(t) * p[w][c] / shared[w]) / (t[c] + other) for c in (0, 1)]
            x = np.log(q[1] / q[0])
            if abs(x - ratio.get(w, 0)) >= toxicity.NEUTRAL:
                pairs[h, w] = x
    return ratio, pairs


@pytest.mark.parametrize("hot", [1 / 1000, 1 / 20])
def test_toxicity_models(spark, monkeypatch, hot):
    """Ratios of words and pairs against their definition; a pair of harmless words is learnt as well."""
    for name, value in (("HOT", hot), ("NEUTRAL", 0.4), ("PAIR", 5.0)):
        monkeypatch.setattr(toxicity, name, value)
    rnd = random.Random(12)
    pool = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(900):
        own = rnd.choices(pool, k=rnd.randrange(10, 40)) + rnd.choices(["up", "yours"], k=3)
        rnd.shuffle(own)
        if i % 10 == 0:
            for _ in range(12):
                at = rnd.randrange(len(own) + 1)
                own[at:at] = rnd.choice([["up", "yours"], ["up", "yours"], ["nasty"]])
        texts.append(" ".join(own))
    texts += [texts[0]] * 30 + ["", "one"]
    rows = [(t, int(i % 10 == 0)) for i, t in enumerate(texts)]
    sample = spark.createDataFrame(rows, "text string, toxic int").repartition(3)
    own, pairs = toxicity.ratios(sample)
    ratio, told = _toxicity_ratios(rows)
    assert {r.w: pytest.approx(r.ratio) for r in own.collect()} == {toxicity.code(w.encode()): x for w, x in ratio.items()}
    assert {(r.h, r.w): pytest.approx(r.ratio) for r in pairs.collect()} == {tuple(toxicity.code(x.encode()) for x in k): v for k, v in told.items()}
    assert "nasty" in ratio and ("up", "yours") in told


def test_toxicity_short_and_long_texts(spark, odd):
    """One toxic word is enough, alone, repeated or among others; very long texts and clashing columns are read alike."""
    rnd = random.Random(4)
    pool = ["".join(rnd.choices("abcdefghij", k=4)) for _ in range(400)]
    texts = [" ".join(rnd.choices(pool, k=30) + (["vile", *rnd.choices(pool, k=3), "vile"] if i % 5 == 0 else [])) for i in range(600)]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int"))
    short = ["vile", "vile vile", "vile word", "word vile vile", " ".join(pool[:10] + ["vile"]), "word", "", pool[0]]
    got = [model.score(x) >= toxicity.THRESHOLD for x in model.evidence(short)]
    assert got == [True] * 5 + [False] * 3
    assert toxicity.score(odd, model, odd.columns).count() == odd.count()
    marked = toxicity.score(docs, model, docs.columns).collect()
    assert all(r.row.score == 0.5 for r in marked)


def _components(n, linked):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(a) for a in range(n)]


@pytest.mark.parametrize("radius", [0, 2, 7, 20])
def test_bit_sliced_links(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 8, dtype=np.uint64)
    fps = base[rng.integers(0, 8, 300)]
    for _ in range(radius):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
    sizes = np.array([1, 2, 63, 64, 170])
    found = {(int(i), int(j)) for a, b in simhash.links(fps, sizes, radius, 1000) for i, j in zip(a, b)}
    want, at = set(), 0
    for n in sizes:
        want |= {(i, j) for i in range(at, at + n) for j in range(i + 1, at + n) if bin(int(fps[i] ^ fps[j])).count("1") <= radius}
        at += n
    assert found == want


@pytest.mark.parametrize("most", [4096, 3])
def test_fingerprint_edges(spark, most):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *[base[rng.integers(0, 12, 60)] ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for _ in range(2)]]))
    nodes = spark.createDataFrame([(i, simhash._signed(int(f))) for i, f in enumerate(fps)], "node long, fp long")
    got = {(r.node, r.component) for r in simhash.components(simhash.fingerprint_edges(nodes, 2, most)).collect()}
    label = _components(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if bin(int(fps[i] ^ fps[j])).count("1") <= 2])
    sizes = Counter(label)
    assert got == {(i, c) for i, c in enumerate(label) if sizes[c] > 1}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200) if i != 99], "u long, v long")
    got = {r.node: r.component for r in simhash.components(edges).collect()}
    assert got == {i: 0 if i < 100 else 100 for i in range(201)}


def _simhash(text):
    own = text.encode().lower().split()
    import xxhash

    h = [xxhash.xxh64_intdigest(b" ".join(own[k : k + 3]), 42) for k in range(max(1, len(own) - 2))] if own else []
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, data, docs):
    fps = [_simhash(t) for _, t in docs]
    label = _components(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2])
    want = {(d, f"{f:016x}", docs[c][0]) for (d, _), f, c in zip(docs, fps, label)}
    assert {tuple(r) for r in simhash.op8_simhash(spark, data).collect()} == want


@pytest.mark.parametrize("most", [4096, 4])
def test_similar_groups(spark, most, monkeypatch):
    rnd = random.Random(6)
    pool = [f"w{i}" for i in range(3000)]
    passage = " ".join(rnd.choices(pool, k=40))
    texts = []
    for _ in range(25):
        base = rnd.choices(pool, k=120)
        texts.append(" ".join(base))
        for _ in range(3):
            own = list(base)
            for _ in range(rnd.randrange(1, 3)):
                own[rnd.randrange(len(own))] = "changed"
            texts.append(" ".join(own))
        texts.append(passage + " " + " ".join(rnd.choices(pool, k=80)))
    texts += ["", None, texts[0]]
    sets = [frozenset(tuple((t or "").split()[k : k + 5]) for k in range(max(1, len((t or "").split()) - 4))) if (t or "").split() else frozenset() for t in texts]
    label = _components(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    monkeypatch.setattr(simhash.similar_edges, "__defaults__", (most,))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    wrong = sum(got[i] != c for i, c in enumerate(label))
    assert len(got) == len(texts) and wrong <= 2
    assert simhash.one_of_each(docs).columns == ["doc_id", "text"]


def test_similar_groups_repeated_lines(spark):
    """Near copies that differ in how often a line is repeated: the sets are alike, the counts are not."""
    rnd = random.Random(9)
    texts = []
    for times in (5, 10, 20, 40) * 10:
        body, line = ([f"w{rnd.randrange(10**6)}" for _ in range(n)] for n in (200, 20))
        texts += [" ".join(body + line), " ".join(body + line * times)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def test_candidates_lose_nothing():
    rng = np.random.default_rng(10)
    base = [rng.choice(1 << 20, int(rng.integers(1, 900)), replace=False) for _ in range(40)]
    sets = [frozenset(np.concatenate([b[: max(1, int(len(b) * f))], rng.choice(1 << 20, int(len(b) * g))]).tolist()) for b in base for f, g in ((1, 0), (0.95, 0), (0.85, 0.02), (0.8, 0), (1, 0.3))]
    size = np.array([len(x) for x in sets])
    bins = np.array([np.minimum(np.bincount([v % simhash.BINS for v in x], minlength=simhash.BINS), 255) for x in sets]).astype(np.uint8)
    got = {(min(p), max(p)) for i, j in simhash.candidates(size, bins, 0.8, lambda i, j: np.ones(len(i), bool), chunk=500) for p in zip(i.tolist(), j.tolist(), strict=True)}
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert want <= got and len(want) > 80 and len(got) < len(sets) * (len(sets) - 1) / 8


def test_simhash_edges(odd, none):
    rows = {r.doc_id: r for r in simhash.fingerprint_groups(odd).collect()}
    assert rows[0].component_id == rows[1].component_id == rows[12].component_id == 0 and rows[0].fp == 0
    assert simhash.one_of_each(odd).columns == odd.columns
    assert simhash.fingerprint_groups(none).count() == 0 and simhash.one_of_each(none).count() == 0


def _word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance():
    rng = np.random.default_rng(7)
    for _ in range(200):
        a, b = rng.integers(0, 4, int(rng.integers(1, 14))), rng.integers(0, 4, int(rng.integers(1, 14)))
        d = _word_distance(a.tolist(), b.tolist())
        for most in (0, 2, 5, 14):
            assert decontamination.edit_distance(a, b, most) == min(d, most + 1)


def test_decontamination_recall(spark, none):
    """Every window against every item, by brute force."""
    rnd = random.Random(8)
    pool = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choices(pool, k=rnd.randrange(8, 50)))) for i in range(30)] + [(98, ""), (99, None)]
    rows = []
    for d in range(120):
        own = rnd.choices(items[:30])[0][1].split()
        for _ in range(rnd.randrange(0, len(own) // 4 + 1)):
            k = rnd.randrange(len(own))
            own[k : k + rnd.randrange(2)] = rnd.choices(pool, k=rnd.randrange(2))
        rows.append((d, " ".join(rnd.choices(pool, k=30) + own + rnd.choices(pool, k=30)).upper() + "."))
    rows += [(500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contamination(docs, bench).collect()}
    want = set()
    for d, text in rows:
        w = (text or "").lower().replace(".", "").split()
        for i, item in items[:30]:
            q = item.split()
            if any(_word_distance(q, w[s : s + len(q)]) <= int(0.2 * len(q) + 1e-9) for s in range(max(1, len(w) - len(q) + 1)) if len(set(q) & set(w[s : s + len(q)])) > len(set(q)) / 2):
                want.add((d, i))
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 60
    assert decontamination.contamination(none, bench).count() == 0
    assert decontamination.contamination(docs, bench.where("false")).count() == 0
    assert decontamination.uncontaminated(docs, bench).columns == docs.columns


@pytest.mark.parametrize("where", ["anywhere", "head", "tail"])
@pytest.mark.parametrize("n", [10, 14, 20, 31, 40, 63, 100, 130])
def test_decontamination_at_the_allowed_distance(n, where):
    """Windows with as many edits as are allowed, spread or gathered on one side."""
    rnd = random.Random(n)
    pool = [f"w{i}" for i in range(400)]
    block = decontamination.Block([(i, " ".join(rnd.choices(pool, k=n))) for i in range(30)], 0.8, decontamination.WALKS, decontamination.SAMPLES)
    allowed, found, true = int(0.2 * n + 1e-9), 0, 0
    for i, (_, seq) in enumerate(block.items):
        for _ in range(2):
            own = seq.tolist()
            for _ in range(allowed):
                low, high = {"anywhere": (0, len(own)), "head": (0, len(own) // 2), "tail": (len(own) // 2, len(own))}[where]
                at = rnd.randrange(low, high)
                own[at : at + rnd.randrange(2)] = rnd.choices(range(1, block.width), k=rnd.randrange(2))
            codes = np.array(rnd.choices(range(block.width), k=9) + own + rnd.choices(range(block.width), k=n))
            if any(decontamination.edit_distance(seq, codes[s : s + n], allowed) <= allowed for s in range(len(codes) - n + 1)):
                true += 1
                found += (0, i) in block.search(codes, np.array([len(codes)]))
    assert found >= 0.95 * true and true > 10


def test_decontamination_edges(spark, monkeypatch):
    """Short documents, null and repeated doc_ids, very long texts, clashing columns, several blocks."""
    item = " ".join(f"q{i}" for i in range(20))
    long = "filler words here " * 40_000
    rows = [(5, item, 1), (9, "nothing in it", 2), (None, item, 3), (None, "nothing here either", 4), (9, item + " more", 5), (7, " ".join(item.split()[:19]), 6), (8, " ".join(item.split()[:12]), 7), (4, long + item + " " + long, 8), (3, None, 9), (9, "nothing in it", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame([(1, item), (2, "some other words that are nowhere to be found"), (3, None), (4, item)], "item_id long, text string")
    for most in (10_000, 1):
        monkeypatch.setattr(decontamination, "BLOCK_ITEMS", most)
        got = {(r.doc_id, r.item_id, r.distance) for r in decontamination.contamination(docs, bench).collect()}
        assert got == {(d, i, int(d == 7)) for d in (5, None, 9, 7, 4) for i in (1, 4)}
        clean = decontamination.uncontaminated(docs, bench)
        assert clean.columns == docs.columns and sorted(r.item_id for r in clean.collect()) == [2, 2, 4, 7, 9]
        assert decontamination.uncontaminated(docs, bench.where("false")).count() == len(rows)
        assert decontamination.uncontaminated(docs.where("false"), bench).count() == 0


def test_near_copies_by_row(spark):
    """Rows with a null or a repeated doc_id are linked by their texts alone; one row of each group stays."""
    pool = [f"w{i}" for i in range(500)]
    rnd = random.Random(3)
    a, b, c = (" ".join(rnd.choices(pool, k=60)) for _ in range(3))
    near = a.split()
    near[30] = "changed"
    rows = [(5, a, 0), (9, b, 1), (None, a, 2), (None, b, 3), (None, c, 4), (9, c, 5), (9, " ".join(near), 6), (None, "alone", 7), (None, "alone", 8), (2, None, 9), (3, "", 10), (3, "", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int").repartition(4)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    own = [r.key for r in kept.collect()]
    assert sorted(x if x not in (7, 8) else 7 for x in own) == [0, 1, 5, 7, 9]
    groups = Counter((r.doc_id, r.component_id) for r in simhash.similar_groups(docs).collect())
    assert groups == Counter([(5, 5), (9, 9), (None, 5), (None, 9), (None, 9), (9, 9), (9, 5), (None, None), (None, None), (2, 2), (3, 2), (3, 2)])
    exact = exact_dedup.keep_first(docs).collect()
    assert Counter((r.doc_id, r.text or "") for r in exact) == Counter([(5, a), (9, b), (9, c), (9, " ".join(near)), (None, "alone"), (3, "")])


def test_large_group_of_near_copies(spark):
    """A block far above the limit: a large group, two halves that one text links, and texts that share a passage only."""
    rnd = random.Random(13)
    pool = [f"w{i}" for i in range(4000)]
    passage = rnd.choices(pool, k=30)
    base = passage + rnd.choices(pool, k=150)
    texts = []
    for _ in range(120):
        own = list(base)
        own[rnd.randrange(30, 180)] = "changed"
        texts.append(" ".join(own))
    other = base[:150] + rnd.choices(pool, k=30)
    texts += [" ".join([*other[:i], "else", *other[i + 1 :]]) for i in range(60, 100)]
    texts += [" ".join(passage + rnd.choices(pool, k=120)) for _ in range(60)]
    sets = [frozenset(tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)) for t in texts]
    label = _components(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for most in (1024, 16):
        own = simhash.similar_edges.__defaults__
        simhash.similar_edges.__defaults__ = (most,)
        try:
            got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
        finally:
            simhash.similar_edges.__defaults__ = own
        assert [got[i] for i in range(len(texts))] == label


def test_recall_at_the_threshold(spark):
    """A thousand pairs near 0.8, some with a line that one of them repeats."""
    rnd = random.Random(14)
    texts = []
    for i in range(1000):
        own = [f"w{rnd.randrange(10**7)}" for _ in range(rnd.randrange(60, 200))]
        copy = list(own)
        for at in rnd.sample(range(0, len(own), 5), max(1, len(own) // 60)):
            copy[at] = "changed"
        line = [f"v{rnd.randrange(10**7)}" for _ in range(12)]
        texts += [" ".join(own + line), " ".join(copy + line * (1 + i % 5))]
    sets = [frozenset(tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)) for t in texts]
    alike = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) >= 0.8 for i in range(0, len(texts), 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    assert [got[2 * i + 1] == 2 * i for i in range(1000)] == alike and sum(alike) > 500


def test_hilbert_curve(spark):
    from pyspark.sql import functions as F

    n, bits = hilbert_shards.DIMENSIONS, hilbert_shards.BITS
    grid = spark.range(1 << n * bits).select(*[F.shiftright("id", bits * i).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias(f"c{i}") for i in range(n)])
    rows = grid.select("*", hilbert_shards.hilbert_index([F.col(f"c{i}") for i in range(n)]).alias("k")).orderBy("k").collect()
    assert [r.k for r in rows] == list(range(1 << n * bits))
    assert all(sum(abs(x - y) for x, y in zip(a[:n], b[:n])) == 1 for a, b in zip(rows, rows[1:]))


def test_hilbert_shards(spark, odd, none, data, docs):
    for df in (hilbert_shards.op10_hilbert_shards(spark, data), hilbert_shards.hilbert_shards(odd, 4)):
        rows = df.collect()
        slots = {}
        for r in rows:
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    got = {r.doc_id: (r.size, r.text_crc32) for r in hilbert_shards.op10_hilbert_shards(spark, data).collect()}
    assert got == {d: (len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in docs}
    assert hilbert_shards.hilbert_shards(none).count() == 0
    written = spark.read.parquet(hilbert_shards.write_shards(odd, shards=3))
    assert written.count() == odd.count()


def test_shards_can_be_pruned(spark, data):
    """Along the shards the curve never goes back, and a source or a language lies in half of the files at most."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = sorted(hilbert_shards.hilbert_shards(docs).collect(), key=lambda r: (r.shard, r.slot))
    assert all(a.curve <= b.curve for a, b in zip(rows, rows[1:]))
    written = spark.read.parquet(hilbert_shards.write_shards(docs))
    for column in ("lang", "source"):
        ends = written.groupBy("_hd_shard").agg({column: "min"}).join(written.groupBy("_hd_shard").agg({column: "max"}), "_hd_shard").collect()
        values = [r[0] for r in written.select(column).distinct().collect() if r[0] is not None]
        touched = [sum(e[1] <= v <= e[2] for e in ends) for v in values]
        assert sum(touched) / len(touched) <= len(ends) / 2


def test_sha_of_kept_lines(spark, data, docs):
    got = {r.doc_id: r.kept_sha256 for r in line_dedup.op2_line_dedup(spark, data).collect()}
    assert got == {d: hashlib.sha256(t.encode()).hexdigest() for d, _, _, t in _line_dedup(docs)}


def test_pipeline(spark, data, docs):
    import corpus_pipeline

    frame = spark.read.parquet(f"{data}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in frame.select("doc_id").collect()}
        after = stage(spark, frame, data)
        assert after.columns == frame.columns
        frame = spark.createDataFrame(after.collect(), frame.schema)
        assert {r.doc_id for r in frame.select("doc_id").collect()} <= before
    kept = {r.doc_id for r in frame.select("doc_id").collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, frame, data)
    assert {r.doc_id for r in last.collect()} == kept and len(kept) > 0.7 * len(docs)


def test_packing_needs_few_sequences(spark, data, docs):
    """No more sequences than best-fit decreasing, piece by piece, and hardly more than the tokens fill."""
    got = packing.op4_best_fit_packing(spark, data).select("length", "sequence_id").collect()
    room = []
    for n in sorted((r.length for r in got), reverse=True):
        at = min((i for i, x in enumerate(room) if x >= n), key=lambda i: room[i], default=None)
        if at is None:
            room.append(2048 - n)
        else:
            room[at] -= n
    used = len({r.sequence_id for r in got})
    assert used <= len(room) + 1 and used >= -(-sum(r.length for r in got) // 2048)


def _curve_index(point):
    """Hilbert index by the published transposed form (Skilling 2004), in plain integers."""
    n, b, x = hilbert_shards.DIMENSIONS, hilbert_shards.BITS, list(point)
    q = 1 << (b - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (b - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    return sum((x[i] >> k & 1) << (k * n + n - 1 - i) for k in range(b) for i in range(n))


def test_shards_by_brute_force(spark, data, docs):
    """Every row's curve index from its cell, and shards as runs of equal counts along the order."""
    frame = spark.read.parquet(f"{data}/documents.parquet")
    cells = {(r.doc_id, r.text_crc32): _curve_index((r.d0, r.d1, r.d2)) for r in hilbert_shards._cells(frame).collect()}
    rows = hilbert_shards.hilbert_shards(frame, 24).collect()
    assert all(cells[r.doc_id, r.text_crc32] == r.curve for r in rows)
    along = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in along] == sorted(cells.values())
    assert [r.shard for r in along] == [i * 24 // len(rows) for i in range(len(rows))]


def _kept_by_brute_force(rows, labels, items):
    """The pipeline's rows by plain loops, but for the scores of the toxicity stage, which come from its model."""
    last = {}
    for i, (doc, text) in enumerate(rows):
        key = text or ""
        best = last.get(key)
        if best is None or (rows[best][0] is not None, rows[best][0] or 0) < (doc is not None, doc or 0):
            last[key] = i
    own = sorted(last.values())
    sets = []
    for i in own:
        w = (rows[i][1] or "").lower().split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    label = _components(len(own), [(a, b) for a in range(len(own)) for b in range(a) if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    best = {}
    for k, c in enumerate(label):
        doc = rows[own[k]][0]
        if c not in best or (doc is None, doc or 0) < (rows[best[c]][0] is None, rows[best[c]][0] or 0):
            best[c] = own[k]
    out = []
    for i in sorted(best.values()):
        w = [x.decode() for x in words(rows[i][1])]
        leak = False
        for _, item in items:
            q = [x.decode() for x in words(item)]
            if q:
                spans = range(max(1, len(w) - len(q) + 1))
                leak |= any(_word_distance(q, w[s : s + len(q)]) <= int(0.2 * len(q) + 1e-9) for s in spans if len(set(q) & set(w[s : s + len(q)])) >= len(set(q)) / 2)
        if not leak:
            out.append(i)
    return out


def test_pipeline_by_brute_force(spark, tmp_path, monkeypatch):
    """Nulls, empty texts, ties, repeated rows and leaks through all stages; then empty tables."""
    import corpus_pipeline

    for name, value in (("WORD", 1.0), ("NEUTRAL", 1.0)):  # a table as small as this one tells little
        monkeypatch.setattr(toxicity, name, value)
    rnd = random.Random(15)
    pool = [f"w{i}" for i in range(600)]
    item = " ".join(rnd.choices(pool, k=20))
    base = [" ".join(rnd.choices(pool, k=rnd.randrange(30, 90))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(20):
        own = base[i].split()
        own[rnd.randrange(len(own))] = "changed"
        rows.append((100 + i, " ".join(own)))
    rows += [(200, base[1]), (None, base[2]), (None, base[3]), (7, base[4]), (7, base[5]), (7, base[5]), (201, item), (202, base[6] + " " + item), (None, "x " + item), (None, "alone one"), (None, "alone two")]
    rows += [(203, None), (204, ""), (None, None), (205, "w1 w2"), (205, "w1 w2")]
    rows += [(300 + i, " ".join(x for k, w in enumerate(rnd.choices(pool, k=30)) for x in ([w, "vile"] if k % 2 else [w]))) for i in range(150)]
    labels = [(i, 1, int(i >= 300)) for i in [*range(60), *range(300, 450)]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, frame in (
        ("documents", spark.createDataFrame([(d, t, None, "s", 1) for d, t in rows], schema)),
        ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int")),
        ("benchmark", spark.createDataFrame([(1, item), (2, None)], "item_id long, text string")),
    ):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
        frame.where("false").write.parquet(f"{tmp_path}/none/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "length").collect()
    clean = [r for r in rows if "vile" not in (r[1] or "")]
    want = [clean[i] for i in _kept_by_brute_force(clean, labels, [(1, item)])]
    assert Counter((r.doc_id, r.length) for r in got) == Counter((d, len(_ids(t or "", 0))) for d, t in want)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def _kneser_ney(rows):
    """Log ratio of any word after any other under both models, by their definition over dictionaries."""
    pair, kinds, follow = Counter(), {}, {}
    for text, c in rows:
        own = ["", *[w.decode() for w in words(text)]]
        pair.update((c, h, w) for h, w in zip(own, own[1:]))
    for c, h, w in pair:
        for k in (c, "both"):
            kinds.setdefault((k, w), set()).add(h)
            follow.setdefault((k, h), set()).add(w)
    d, word, other = toxicity.DISCOUNT, toxicity.WORD, toxicity.PAIR
    every = {k: sum(len(v) for (c, _), v in kinds.items() if c == k) for k in (0, 1, "both")}
    v = {k: sum(c == k for c, _ in kinds) for k in (0, 1, "both")}
    begun = Counter()
    for (c, h, _), n in pair.items():
        begun[c, h] += n
    of = lambda table, *key: len(table.get(key, ()))

    def ratio(h, w):
        n = [pair[c, h, w] for c in (0, 1)]
        p = (max(of(kinds, "both", w) - d, 0) + d * v["both"] / (v["both"] + 1)) / every["both"]
        own = [(max(of(kinds, c, w) - d, 0) + (d * v[c] + word) * p) / (every[c] + word) for c in (0, 1)]
        # Where neither model has the pair or its first word, what both share of it cancels out.
        shared = (max(sum(n) - d, 0) + d * of(follow, "both", h) * p) / max(1, begun[0, h] + begun[1, h]) or p
        x = [(max(n[c] - d, 0) + (d * of(follow, c, h) + other) * shared * own[c] / p) / (begun[c, h] + other) for c in (0, 1)]
        x = np.log(x[1] / x[0])
        return x if abs(x) >= toxicity.NEUTRAL else 0.0

    return ratio


@pytest.mark.parametrize("hot", [1 / 1000, 1 / 20])
def test_toxicity_evidence_by_brute_force(spark, monkeypatch, hot):
    """evidence of texts is the sum of all log ratios, of pairs met once or twice and of unknown words as well."""
    for name, value in (("HOT", hot), ("NEUTRAL", 0.3), ("WORD", 20.0), ("PAIR", 5.0)):
        monkeypatch.setattr(toxicity, name, value)
    rnd = random.Random(21)
    pool = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        own = rnd.choices(pool, weights=range(1, 121), k=rnd.randrange(1, 30))
        if i % 7 == 0:
            own += ["up", "yours", "nasty"]
        rows.append((" ".join(own), int(i % 7 == 0)))
    rows += [rows[0]] * 5 + [("", 0), ("w1", 1), ("only here twice only here twice", 1), ("here only twice", 0)]
    model = toxicity._fit_models(spark.createDataFrame(rows, "text string, toxic int").repartition(3), 0.1)
    texts = [t for t, _ in rows] + ["", "nasty", "unknown", "unknown nasty words up yours", "only here twice", "here only twice", "yours up"]
    ratio = _kneser_ney(rows)
    want = []
    for t in texts:
        own = ["", *[w.decode() for w in words(t)]]
        want.append(sum(ratio(h, w) for h, w in zip(own, own[1:])) / (len(own) - 1 + toxicity.LENGTH_PRIOR))
    assert model.evidence(texts) == pytest.approx(want)
    assert len(model.pairs) > 20


def test_toxicity_rare_pairs(spark, monkeypatch):
    """a pair met three times is listed; pairs below four contexts were dropped before."""
    monkeypatch.setattr(toxicity, "NEUTRAL", 0.3)
    monkeypatch.setattr(toxicity, "PAIR", 5.0)
    rnd = random.Random(22)
    rows = [(" ".join(rnd.choices([f"w{i}" for i in range(40)] + ["up", "yours"], k=30)), 0) for _ in range(300)]
    rows += [(f"z{i} up yours", 1) for i in range(3)] + [("up w1 yours w2", 1)] * 5
    told = {(r.h, r.w) for r in toxicity.tables(spark.createDataFrame(rows, "text string, toxic int"))[1].collect()}
    assert (toxicity.code(b"up"), toxicity.code(b"yours")) in told


def test_cut_leaves_no_shuffle_files(spark):
    """What was shuffled for a table that is written goes with the query; it lay there until the garbage collector came."""

    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        names = (held.apply(i).toString() for i in range(held.size()))
        return {x for x in names if x.startswith("shuffle_") and x.endswith(".data")}

    before = files()
    table = cut(spark.range(1000).repartition(4, "id"), "test-cut")
    until = time.time() + 5
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert table.count() == 1000


def test_lean_gives_memory_back():
    """A worker that waits for its next task holds none of what its last one freed."""
    import psutil

    rss, held, batch = psutil.Process().memory_info, [], pa.RecordBatch.from_arrays([pa.array([1])], ["x"])

    def run(batches):
        for b in batches:
            own = [np.ones(8000) for _ in range(3000)]
            held.extend(own[::100])  # what stays lies between what goes
            del own
            yield b

    before = rss().rss
    assert list(lean(run)([batch])) == [batch]
    assert rss().rss - before < 60e6 and len(held) == 30
