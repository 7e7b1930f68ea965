"""Licence scanning with a generalised suffix automaton of licence tokens.

The automaton holds every word string of the licence templates. A text streams through it and gives matching
statistics: for each word, the longest string of template words that ends there. The suffix links of its state lead to
the templates that hold only a shorter end of it. In each template, matches of at least MIN_MATCH words that its next
word does not extend are placed, and matches that follow each other in text and
template (at most GAP words apart in the text) are chained into covered template spans. A template whose chain covers
COVER of its words gives its label; so do the base phrases. Only runs of words of the automaton's vocabulary are
walked; everything before that is vectorised.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z in lower case. Null and empty texts have no words.
Repeated rows are scanned each; extra columns are ignored; an empty table gives an empty result. A chain is looked for
among all matches within the gap, so repeated licence lines cost time in proportion to their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import LOWER, read, restored, slices, text_bytes, texts, word_hashes, word_spans

MIN_MATCH = 4
GAP = 40
COVER = 0.5

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAPS = np.array([b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F for b in range(256)])

#: Phrases of the base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public licence texts and notices, by label.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class SuffixAutomaton:
    """Of several token strings; every state knows where its strings end in the templates."""

    def __init__(self, strings: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for t, string in enumerate(strings):
            last = 0
            for k, token in enumerate(string):
                last = self._extend(last, token)
                self.ends[last].add((t, k))
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.ends[self.link[s]] |= self.ends[s]

    @lru_cache(maxsize=None)  # noqa: B019  one automaton lives as long as its worker
    def places(self, state: int) -> tuple[tuple[int, int, int], ...]:
        """(template, end, words) of the strings of a state and of its suffixes down to MIN_MATCH words; 0 words: as many as match."""
        found = [(t, e, 0) for t, e in sorted(self.ends[state])]
        while self.link[state] > 0 and self.length[self.link[state]] >= MIN_MATCH:
            shorter = self.link[state]
            found += [(t, e, self.length[shorter]) for t, e in sorted(self.ends[shorter] - self.ends[state])]
            state = shorter
        return tuple(found)

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.next.append(step)
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.next) - 1

    def _clone(self, p: int, token: int, q: int) -> int:
        c = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def _extend(self, last: int, token: int) -> int:
        q = self.next[last].get(token)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, token, q)
        new, p = self._new(self.length[last] + 1, {}, 0), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, token, q)
        return new

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """(state, longest match) at each token."""
        state, length = 0, 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            yield state, length


class Scanner:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES):
        strings = [words(text.encode()) for _, text in templates]
        vocabulary = sorted({w for s in strings for w in s} | {w.encode() for p in phrases for w in p.split()})
        self.labels, self.sizes = [label for label, _ in templates], [len(s) for s in strings]
        number = {w: k for k, w in enumerate(vocabulary)}
        self.tokens = [[number[w] for w in s] for s in strings]
        self.automaton = SuffixAutomaton(self.tokens)
        self.phrases = [([number[w.encode()] for w in p.split()], label) for p, label in phrases.items()]
        data = np.frombuffer(b" ".join(vocabulary), np.uint8)
        starts, ends = word_spans(data, np.array([0, len(data)]), GAPS)
        hashes = word_hashes(data, starts, ends)
        order = np.argsort(hashes)
        self.hashes, self.order = hashes[order], order

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The vocabulary number of each word, -1 for others."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def spans(self, tokens: np.ndarray, first: int) -> list[tuple[int, int, int, int]]:
        """Matches (template, start in text, start in template, words) of a run of vocabulary words that starts at `first`."""
        follow, out = [*tokens.tolist()[1:], None], []
        for j, (state, length) in enumerate(self.automaton.statistics(tokens.tolist())):
            if length >= MIN_MATCH:
                for t, e, n in self.automaton.places(state):
                    if e + 1 == self.sizes[t] or self.tokens[t][e + 1] != follow[j]:
                        n = n or length
                        out.append((t, first + j - n + 1, e - n + 1, n))
        return out

    def chained(self, matches: list[tuple[int, int, int, int]]) -> dict[int, tuple[int, int, int]]:
        """Per template, the best chain: words covered, first and last word in the text."""
        best: dict[int, tuple[int, int, int]] = {}
        by_template: dict[int, list] = {}
        for t, a, b, n in matches:
            by_template.setdefault(t, []).append((a, b, n))
        for t, ms in by_template.items():
            ms.sort()
            chains: list[tuple[int, int]] = []  # words covered, first word
            low = 0
            for k, (a, b, n) in enumerate(ms):
                cover, start = n, a
                while low < k and ms[low][0] + self.sizes[t] + GAP < a:
                    low += 1
                for i in range(low, k):
                    x, y, m = ms[i]
                    # strings may overlap; only what lies beyond counts
                    over = max(0, x + m - a, y + m - b)
                    if x < a and y < b and over < n and a - (x + m) <= GAP and chains[i][0] + n - over > cover:
                        cover, start = chains[i][0] + n - over, chains[i][1]
                chains.append((cover, start))
                if cover > best.get(t, (0, 0, 0))[0]:
                    best[t] = (cover, start, a + n - 1)
        return best


@lru_cache(1)
def scanner() -> Scanner:
    return Scanner()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scan = scanner()
    span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("words", pa.int64()), ("cover", pa.float64())]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), span)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        off, data = text_bytes(batch.column(1))
        for lo, hi in slices(off):
            part, bounds = LOWER[data[off[lo] : off[hi]]], off[lo : hi + 1] - off[lo]
            starts, ends = word_spans(part, bounds, GAPS)
            first = np.searchsorted(starts, bounds)
            number = scan.numbers(word_hashes(part, starts, ends))
            row = np.repeat(np.arange(hi - lo), np.diff(first))
            places: list[list[tuple[int, int, str]]] = [[] for _ in range(hi - lo)]
            for tokens, label in scan.phrases:
                n = len(tokens)
                if len(number) >= n:
                    good = row[: len(row) - n + 1] == row[n - 1 :]
                    for k, token in enumerate(tokens):
                        good &= number[k : len(number) - n + 1 + k] == token
                    for at in np.flatnonzero(good):
                        places[row[at]].append((int(at - first[row[at]]), n, label))
            # runs of vocabulary words inside one text, long enough for a match
            known = number >= 0
            edge = np.ones(len(number), bool)
            edge[1:] = (known[1:] != known[:-1]) | (row[1:] != row[:-1])
            run = np.flatnonzero(edge)
            size = np.diff(np.append(run, len(number)))
            matches: list[list] = [[] for _ in range(hi - lo)]
            for a, n in zip(run[known[run] & (size >= MIN_MATCH)], size[known[run] & (size >= MIN_MATCH)], strict=True):
                matches[row[a]] += scan.spans(number[a : a + n], int(a - first[row[a]]))
            out = []
            for k in range(hi - lo):
                base = sorted({p[2] for p in places[k]})
                found, top = [], 0.5 if base else 0.0
                for t, (cover, x, y) in sorted(scan.chained(matches[k]).items()) if matches[k] else ():
                    share = min(1.0, cover / scan.sizes[t])
                    top = max(top, share)
                    if share >= COVER:
                        found.append({"label": scan.labels[t], "first_word": x, "last_word": y, "words": cover, "cover": share})
                at = [p[0] for p in places[k]]
                labels = sorted({*base, *(f["label"] for f in found)})
                out.append((ids[lo + k], int(first[k + 1] - first[k]), len(at), min(at, default=None), max(at, default=None), ",".join(base), ",".join(labels), top, found))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """Per document: words, places of base phrases, labels, score, and the covered spans."""
    schema = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<label:string,first_word:bigint,last_word:bigint,words:bigint,cover:double>>"
    return restored(texts(docs).mapInArrow(_scan, schema))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents")).drop("spans")


def brute_base(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels of one text, for tests."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(k, label) for p, label in PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    return len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))
