"""License scans: word-bigram Dice coefficient against licence templates.

Texts and templates are normalised to lower-case words. A template of n bigrams
is found at a place of a document if the n bigrams there reach ``threshold`` by
the Dice coefficient (over multisets: twice the common bigrams over the sum of
both sizes). Documents shorter than the template are compared whole; the
coefficient of sets of sizes a and b is 2 min(a, b) / (a + b) at most, and
templates beyond that bound are not compared. Nor are places where too few bigrams
occur in the template at all, which is a bound from above of the common ones.

Templates are given as a table (license_id, text) or a list; it is the stated query set and is broadcast as a sparse index, whose
size follows from that of the templates alone. The default ones are wordings in which public licences are commonly
granted, and the texts of short licences.

Defined results: null and empty texts, and texts of one word, match nothing;
templates of one word are not looked for. The best place of each template in a
document is found, the first on a tie; of overlapping places of different
templates only the best counts, and of a licence's templates the best. Every row is reported on its own: repeated rows
each time, a null doc_id as null. An empty input gives an empty result. Texts are read whole; other columns are
not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, slices, text_column, words

THRESHOLD = 0.8

#: Identifiers and wordings of public licences.
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", f"{_BSD} {_BSD_TWO}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_TWO} {_BSD_THIRD}"),
    ("BSD", _BSD),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]


def dice(a: Counter, b: Counter) -> float:
    """Twice the common elements over the sum of both sizes."""
    size = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / size if size else 0.0


class Templates:
    """Bigrams of all templates, ready to be looked for."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.code: dict[bytes, int] = {}
        self.names: list[str] = []
        self.bags: list[Counter] = []
        for name, text in templates:
            own = [self.code.setdefault(w, len(self.code) + 1) for w in words(text)]
            if len(own) > 1:
                self.names.append(name)
                self.bags.append(Counter(zip(own, own[1:], strict=False)))
        self.sizes = np.array([sum(b.values()) for b in self.bags])
        pairs = sorted({p for b in self.bags for p in b})
        self.width = len(self.code) + 1
        self.pairs = np.array([a * self.width + b for a, b in pairs] or [0], np.int64)
        #: Templates that have each pair, one pair after the other.
        place = {p: i for i, p in enumerate(pairs)}
        have = sorted((place[p], t) for t, b in enumerate(self.bags) for p in b)
        self.holders = np.array([t for _, t in have], np.int64)
        self.bounds = np.searchsorted(np.array([i for i, _ in have], np.int64), np.arange(len(pairs) + 1))

    def scan(self, codes: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(template, dice, first word, words) of each template found, at its best place."""
        grams = codes[:-1] * self.width + codes[1:]
        at = np.minimum(np.searchsorted(self.pairs, grams), len(self.pairs) - 1)
        hits = np.flatnonzero((self.pairs[at] == grams) & (codes[:-1] > 0) & (codes[1:] > 0))
        if not len(hits):
            return []
        kind, found = at[hits], []
        total = len(grams)
        # Each hit once for every template that has its pair, in order of the templates, then of the places.
        many = self.bounds[kind + 1] - self.bounds[kind]
        at = np.repeat(self.bounds[kind], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        holder, where = self.holders[at], np.repeat(hits, many)
        order = np.argsort(holder, kind="stable")
        where, common = where[order], np.bincount(holder, minlength=len(self.bags))
        until = np.cumsum(common)
        for t in np.flatnonzero(common).tolist():
            n = int(self.sizes[t])
            size = min(n, total)
            need = self.threshold * (n + size) / 2
            if min(n, size) < need or common[t] < need:
                continue
            own = where[until[t] - common[t] : until[t]]
            # A window can be moved on to its first member without losing any, unless it then passes the end.
            start = np.unique(np.minimum(own, total - size))
            inside = np.searchsorted(own, start + size) - np.searchsorted(own, start)
            best = (0.0, 0)
            for s in start[inside >= need].tolist():
                window = codes[s : s + size + 1].tolist()
                d = dice(Counter(zip(window, window[1:], strict=False)), self.bags[t])
                if d > best[0]:
                    best = (d, s)
            if best[0] >= self.threshold:
                found.append((t, best[0], best[1], size + 1))
        # Of overlapping places the one with the higher coefficient counts, then the longer one.
        kept: list[tuple[int, float, int, int]] = []
        for x in sorted(found, key=lambda x: (-x[1], -x[3], x[0])):
            if all(x[2] >= y[2] + y[3] or y[2] >= x[2] + x[3] for y in kept):
                kept.append(x)
        return kept


def scan(docs: DataFrame, templates: list[tuple[str, str]] | DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each document and licence found in it: doc_id, license_id, dice, first_word, n_words."""
    spark = docs.sparkSession
    if isinstance(templates, DataFrame):
        templates = [(r[0], r[1] or "") for r in templates.select("license_id", "text").toLocalIterator()]
    sent = spark.sparkContext.broadcast(Templates(TEMPLATES if templates is None else templates, threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        code = own.code.get
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            texts, ids = batch.column(1), batch.column(0).to_pylist()
            for a, b in slices((len(t.as_py()) for t in texts), 1_000_000):
                for doc, text in zip(ids[a:b], texts.slice(a, b - a), strict=True):
                    split = words(text.as_py())
                    if len(split) < 2:
                        continue
                    codes = np.fromiter((code(w, 0) for w in split), np.int64, len(split))
                    best: dict[str, tuple[float, int, int]] = {}
                    for t, d, s, n in own.scan(codes):
                        name = own.names[t]
                        best[name] = max(best.get(name, (0.0, 0, 0)), (d, -s, -n))
                    for name, (d, s, n) in best.items():
                        for col, x in zip(out, (doc, name, d, -s, -n), strict=True):
                            col.append(x)
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc_id", "license_id", "dice", "first_word", "n_words"])

    slim = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_column(docs).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, license_id string, dice double, first_word bigint, n_words bigint")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence found in a document."""
    return scan(documents(spark, sf_dir))
