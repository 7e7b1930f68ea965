"""Benchmark decontamination by pigeonhole edit matching on words.

An item of n words may be found with up to n // WORDS_PER_ERROR word edits. Split into one piece more than that, at
least one piece of any match is untouched; every piece starts with an ANCHOR of words, so documents are searched for
the anchors' hashes, whole pieces are confirmed, and the text around a hit is verified with Myers' bit-parallel edit
distance over words (any item length, as integers of that many bits).

Words are [0-9a-z] and non-ASCII characters after A-Z are put in lower case; other characters separate. In scripts
without spaces (ALONE: Chinese, Japanese, Thai, Lao, Tibetan, Burmese, Khmer) each character is a word. Items of fewer
than WORDS_PER_ERROR words are searched for word for word; the anchor of one under ANCHOR words is the item. Null or
empty texts, and those without a word, match nothing; repeated items report the same id once, and items without an id
count like others and report a null. Items go to the tasks in blocks of at most BLOCK_ITEMS, all texts are searched
for each block, so memory is bounded for any benchmark. Repeated rows are judged each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, NO_ID, keep_rows, keyed_texts, mix, read, restored, slices, text_bytes, texts, word_hashes, word_spans
from .license_scan import GAPS

WORDS_PER_ERROR = 8
ANCHOR = 4
#: Items sent to the tasks at once.
BLOCK_ITEMS = 20_000

_A = np.uint64(0x9E3779B97F4A7C15)

#: First and second byte in UTF-8 of the characters that are words of their own: U+0E00-109F but no Georgian, 1780-17FF,
#: 2E80-A4CF, F900-FAFF, FF00-FF7F and from U+20000 on.
ALONE = np.zeros((256, 256), bool)
for _lead, _lo, _hi in ((0xE0, 0xB8, 0xBF), (0xE1, 0x80, 0x82), (0xE1, 0x9E, 0x9F), (0xE2, 0xBA, 0xBF), *((b, 0x80, 0xBF) for b in range(0xE3, 0xEA)), (0xEA, 0x80, 0x93), (0xEF, 0xA4, 0xAB), (0xEF, 0xBC, 0xBD), (0xF0, 0xA0, 0xBF)):
    ALONE[_lead, _lo : _hi + 1] = True


def myers(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of the text, and the end (exclusive) of the first such part."""
    n = len(pattern)
    masks: dict[int, int] = {}
    for k, w in enumerate(pattern.tolist()):
        masks[w] = masks.get(w, 0) | 1 << k
    full, top = (1 << n) - 1, 1 << n - 1
    vp, vn, score, best, at = full, 0, n, n, 0
    for j, w in enumerate(text.tolist()):
        eq = masks.get(w, 0)
        x = eq | vn
        d0 = ((vp + (x & vp)) ^ vp | x) & full
        hn = vp & d0
        hp = (vn | ~(vp | d0)) & full
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1 & full, hn << 1 & full
        vp = (hn | ~(d0 | hp)) & full
        vn = hp & d0
        if score < best:
            best, at = score, j + 1
    return best, at


@dataclass
class Items:
    """The pieces of a block of items, by anchor hash."""

    ids: list[int]
    words: list[np.ndarray]

    def __post_init__(self):
        anchors, pieces = [], []
        for k, w in enumerate(self.words):
            n = len(w)
            parts = n // WORDS_PER_ERROR + 1
            cuts = [n * p // parts for p in range(parts + 1)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                anchors.append(int(anchor_hashes(w[a:b], min(ANCHOR, b - a))[0]))
                pieces.append((k, a, b))
        order = np.argsort(np.array(anchors, np.uint64), kind="stable")
        self.anchors = np.array(anchors, np.uint64)[order]
        self.pieces = [pieces[k] for k in order]
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.anchors >> np.uint64(44)] = True
        self.lengths = sorted({min(ANCHOR, b - a) for _, a, b in pieces})

    def hits(self, anchors: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.sieve[anchors >> np.uint64(44)])
        if not len(maybe) or not len(self.anchors):
            return maybe[:0]
        at = np.minimum(np.searchsorted(self.anchors, anchors[maybe]), len(self.anchors) - 1)
        return maybe[self.anchors[at] == anchors[maybe]]

    def matches(self, words: np.ndarray, places: np.ndarray, anchors: np.ndarray) -> list[tuple[int, int, int]]:
        """(item id, distance, end word) per match in one text, from the places of anchor hits."""
        out, done = {}, {}
        for p, h in zip(places.tolist(), anchors.tolist(), strict=True):
            k = int(np.searchsorted(self.anchors, np.uint64(h)))
            while k < len(self.anchors) and int(self.anchors[k]) == h:
                item, a, b = self.pieces[k]
                k += 1
                w = self.words[item]
                errors = len(w) // WORDS_PER_ERROR
                if out.get(self.ids[item], (1, 0))[0] == 0 or not np.array_equal(words[p : p + b - a], w[a:b]):
                    continue
                lo, hi = max(0, p - a - errors), min(len(words), p - a + len(w) + errors)
                if done.get(item, (-1, -1))[0] <= lo and hi <= done.get(item, (-1, -1))[1]:
                    continue
                done[item] = (lo, hi)
                distance, end = myers(w, words[lo:hi])
                if distance <= errors and (self.ids[item] not in out or distance < out[self.ids[item]][0]):
                    out[self.ids[item]] = (distance, lo + end)
        return [(i, d, e) for i, (d, e) in out.items()]


def anchor_hashes(words: np.ndarray, length: int = ANCHOR) -> np.ndarray:
    """Hashes of the words from each place, `length` of them."""
    n = len(words) - length + 1
    h = words[: max(n, 0)] * _A
    for k in range(1, length):
        h = mix(h + words[k : k + max(n, 0)]) * _A
    return h


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; characters of scripts without spaces are cut out of the runs that hold them."""
    starts, ends = word_spans(data, bounds, GAPS)
    at = np.flatnonzero(data[:-1] >= 0xE0)
    at = at[ALONE[data[at], data[at + 1]]]
    if not len(at):
        return starts, ends
    cuts = np.unique(np.concatenate([at, at + np.where(data[at] >= 0xF0, 4, 3)]))
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    inner = cuts[~GAPS[data[cuts - 1]] & ~GAPS[data[cuts]]]
    inner = np.setdiff1d(inner, starts, assume_unique=True)
    return np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))


def hashed_words(text: bytes) -> np.ndarray:
    data = LOWER[np.frombuffer(text, np.uint8)]
    starts, ends = spans(data, np.array([0, len(data)]))
    return word_hashes(data, starts, ends)


def _search(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        off, data = text_bytes(batch.column(1))
        for lo, hi in slices(off):
            part, bounds = LOWER[data[off[lo] : off[hi]]], off[lo : hi + 1] - off[lo]
            starts, ends = spans(part, bounds)
            words = word_hashes(part, starts, ends)
            first = np.searchsorted(starts, bounds)
            at, anchors, row = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
            for length in items.lengths:
                hashes = anchor_hashes(words, length)
                place = items.hits(hashes)
                of = np.searchsorted(first, place, "right") - 1
                if length < ANCHOR:  # the item itself: its first place in a text is enough
                    _, once = np.unique(np.stack([of.astype(np.uint64), hashes[place]]), axis=1, return_index=True)
                    place, of = place[once], of[once]
                at, anchors, row = np.concatenate([at, place]), np.concatenate([anchors, hashes[place]]), np.concatenate([row, of])
            order = np.lexsort((at, row))
            at, anchors, row = at[order], anchors[order], row[order]
            edge = np.searchsorted(row, np.arange(hi - lo + 1))
            out = []
            for k in range(hi - lo):
                here = at[edge[k] : edge[k + 1]]
                found = items.matches(words[first[k] : first[k + 1]], here - first[k], anchors[edge[k] : edge[k + 1]]) if len(here) else []
                out.append((ids[lo + k], sorted(i for i, _, _ in found), min((d for _, d, _ in found), default=None)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.list_(pa.int64())), pa.array([r[2] for r in out], pa.int64())], names=["doc_id", "item_ids", "distance"])


def _search_keyed(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text_hash, text); the results keep the order of the rows."""
    for batch in batches:
        found = pa.Table.from_batches(_search(iter([batch.select([0, 2])]), items)).combine_chunks().to_batches()
        for part in found:
            yield pa.RecordBatch.from_arrays([batch.column(1), *part.columns], names=["text_hash", *part.schema.names])


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks of about BLOCK_ITEMS items, each small enough for every task."""
    items = texts(benchmark, "item_id")
    n_blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    for block in range(n_blocks):
        held = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)) == block).distinct().collect()
        pairs = [(r["doc_id"], w) for r in held if len(w := hashed_words(r["text"].encode()))]
        yield Items([i for i, _ in pairs], [w for _, w in pairs])


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents with all their columns in which no item is found."""
    for items in item_blocks(benchmark):
        docs = keep_rows(docs, lambda it, items=items: (pa.array([not x for x in b.column(1).to_pylist()], pa.bool_()) for b in _search(it, items)))
    return docs


def shown(found: DataFrame) -> DataFrame:
    """Null ids as null again, of documents and of items."""
    return restored(found).withColumn("item_ids", F.transform("item_ids", lambda i: F.nullif(i, F.lit(NO_ID))))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, item_ids (sorted, null first, of the items found in it), distance (least word edits, null without an item)."""
    kind = "doc_id bigint, item_ids array<bigint>, distance bigint"
    blocks = list(item_blocks(benchmark))
    if len(blocks) == 1:
        return shown(texts(docs).mapInArrow(lambda it: _search(it, blocks[0]), kind))
    every = None
    for k, items in enumerate(blocks):
        found = keyed_texts(docs).mapInArrow(lambda it, items=items: _search_keyed(it, items), f"text_hash bigint, {kind}").withColumn("block", F.lit(k))
        every = found if every is None else every.unionByName(found)
    # A row is named by its id and text hash, which hold however often and in what order the texts are read.
    joined = every.groupBy("doc_id", "text_hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"), F.min("distance").alias("distance"), F.sum(F.when(F.col("block") == 0, 1)).alias("times"))
    return shown(joined.select("doc_id", "item_ids", "distance", F.explode(F.sequence(F.lit(1), "times")).alias("time")).drop("time"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), F.size("item_ids").cast("long").alias("n_items"), "item_ids", "distance")


def brute_force(text: str | None, items: list[tuple[int | None, str]]) -> tuple[list[int | None], int | None]:
    """Items within their budget of one text by the plain table of edit distances, for tests."""
    words, out = hashed_words((text or "").encode()).tolist(), []
    for item_id, item in items:
        w = hashed_words((item or "").encode()).tolist()
        if not w:
            continue
        column = list(range(len(w) + 1))
        best = column[-1]
        for x in words:
            diagonal, column[0] = column[0], 0
            for k in range(1, len(w) + 1):
                diagonal, column[k] = column[k], min(column[k] + 1, column[k - 1] + 1, diagonal + (x != w[k - 1]))
            best = min(best, column[-1])
        if best <= len(w) // WORDS_PER_ERROR:
            out.append((item_id, best))
    return sorted({i for i, _ in out}, key=lambda i: (i is not None, i)), min((d for _, d in out), default=None)
