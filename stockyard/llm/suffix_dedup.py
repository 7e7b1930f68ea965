"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first `threshold` bytes, most significant digit first, and only as far as
needed; suffixes that are still equal after the last digit are exactly the repeated windows.

1. First digit: the leftmost least GRAM in the window. It is the same for equal windows, and one text place in about
   thirty is such an anchor. Windows around an anchor that occurs once are unique and leave here.
2. Second digit: the whole string around the anchor, over all its windows. Anchors whose strings are equal repeat all
   their windows, so one row settles about thirty suffixes.
3. Third digit, for the first of each string whose anchor has several different strings: its windows in cells of CELL
   neighbouring anchor offsets. A cell's core, which all its windows hold, takes the anchor's part: unique cores leave,
   equal strings around them settle a cell.
4. Last digit: the windows themselves, for the first of each string whose core has several.

Each pass deals rows by the digit's hash and sorts them; the sorted rows stream through constant memory. Rows of a hot
digit are first thinned in their task: of equal ones only the earliest is dealt by the digit, the others are known to
repeat and spread evenly. Digits are compared by two 64-bit hashes.

The first occurrence is the one with the smallest (doc_id, place); a null id is the smallest. Null and empty texts have
no bytes. Rows are known by id and text hash: rows that repeat an id with the same text are one document given twice;
different texts under one id (or without any) are documents of which none is earlier, so they take nothing from each
other. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, keyed_texts, mix, read, restored, slices, text_bytes
from .suffix_kernel import GRAM, anchors, gram_hashes, window_hashes

THRESHOLD = 100
#: Rows that are thinned together in a task.
THIN_ROWS = 1 << 19
#: Anchor offsets in a cell of the third digit.
CELL = 12

#: a, b: digit hashes; h: hash of the text; the row stands for the windows that start at s to s + n - 1, around the anchor at s + o; known: settled as repeated already.
ROWS = "a bigint, b bigint, doc_id bigint, h bigint, s bigint, n int, o int, known boolean"
#: fine: the windows still have to be told apart by the next digit.
FOUND = "doc_id bigint, h bigint, s bigint, n int, o int, fine boolean"

_ROWS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("doc_id", pa.int64()), ("h", pa.int64()), ("s", pa.int64()), ("n", pa.int32()), ("o", pa.int32()), ("known", pa.bool_())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("s", pa.int64()), ("n", pa.int32()), ("o", pa.int32()), ("fine", pa.bool_())])


def _thin(a, b, doc, h, s, n, o) -> pa.RecordBatch:
    """Of rows with equal digits in one task, all but the earliest are known to repeat; neighbours among those become one row.

    The earliest are the first of each text under the smallest id.
    """
    order = np.lexsort((s, h, doc, b, a))
    a, b, doc, h, s, n, o = a[order], b[order], doc[order], h[order], s[order], n[order], o[order]
    same = np.zeros(len(a), bool)
    same[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    head = np.flatnonzero(~same)
    first = np.repeat(head, np.diff(np.append(head, len(a))))
    text = ~same  # the first row of each text
    text[1:] |= (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    own = np.flatnonzero(text)
    known = same & ((doc != doc[first]) | (s != s[np.repeat(own, np.diff(np.append(own, len(a))))]))
    k = np.flatnonzero(known)
    k = k[np.lexsort((s[k], h[k], doc[k]))]
    if len(k):
        kd, kh, ks, kn = doc[k], h[k], s[k], n[k].astype(np.int64)
        fresh = np.ones(len(k), bool)
        fresh[1:] = (kd[1:] != kd[:-1]) | (kh[1:] != kh[:-1]) | (ks[1:] != ks[:-1] + kn[:-1])
        at = np.flatnonzero(fresh)
        kn = np.add.reduceat(kn, at)
        kd, kh, ks = kd[at], kh[at], ks[at]
        spread = mix(kd.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ks.astype(np.uint64)).astype(np.int64)
    else:
        kd = kh = ks = kn = spread = np.zeros(0, np.int64)
    u = ~known
    cols = [np.concatenate(x) for x in ((a[u].view(np.int64), spread), (b[u].view(np.int64), spread), (doc[u], kd), (h[u], kh), (s[u], ks), (n[u].astype(np.int32), kn.astype(np.int32)), (o[u].astype(np.int32), np.zeros(len(kd), np.int32)))]
    return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(np.repeat([False, True], [int(u.sum()), len(kd)]))], schema=_ROWS)


def _thinned(parts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for part in parts:
        if len(part[0]):
            held.append(part)
            size += len(part[0])
        if size >= THIN_ROWS:
            yield _thin(*map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield _thin(*map(np.concatenate, zip(*held, strict=True)))


def _anchor_rows(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[tuple]:
    for batch in batches:
        ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        off, data = text_bytes(batch.column(2))
        for lo, hi in slices(off):
            bounds = off[lo : hi + 1] - off[lo]
            grams, s0, s1, at = anchors(data[off[lo] : off[hi]], bounds, threshold)
            if len(at):
                row = np.searchsorted(bounds, at, "right") - 1
                n = s1 - s0 + 1
                whole = _string_hashes(grams, s0, s1, at, threshold)
                yield grams[at], whole, ids[lo + row], hashes[lo + row], s0 - bounds[row], n, at - s0


def _string_hashes(grams: np.ndarray, s0: np.ndarray, s1: np.ndarray, at: np.ndarray, threshold: int) -> np.ndarray:
    """Of the whole string under the windows s0 to s1, with its place around the anchor."""
    return mix(window_hashes(grams, s0, threshold) * np.uint64(3) + mix(window_hashes(grams, s1, threshold) + (s1 - s0 + 1 << 8 | (at - s0)).astype(np.uint64)))


def _runs(column: pa.Array, names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """A column of lists of structs as offsets and one flat array per field; null counts as empty."""
    column = column.fill_null([]) if column.null_count else column
    flat = column.flatten()
    return np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64), [flat.field(x).to_numpy().astype(np.int64) for x in names]


def _cell_rows(batches: Iterator[pa.RecordBatch], threshold: int, width: int) -> Iterator[tuple]:
    """The windows of the runs in cells of `width` anchor offsets: core hash and string hash of each cell."""
    core = threshold - width + 1
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        off, data = text_bytes(batch.column(2))
        first, (s, n, o) = _runs(batch.column(3), "sno")
        for lo, hi in slices(off):
            grams = gram_hashes(data[off[lo] : off[hi]])
            part = slice(first[lo], first[hi])
            row = np.repeat(np.arange(lo, hi), np.diff(first[lo : hi + 1]))
            base = off[row] - off[lo]
            s0 = s[part] + base
            s1 = np.minimum(s0 + n[part] - 1, off[row + 1] - off[lo] - threshold)
            at = s0 + o[part]
            c0, c1 = (at - s1) // width, (at - s0) // width
            cells = np.maximum(c1 - c0 + 1, 0)
            k = np.repeat(np.arange(len(cells)), cells)
            if not len(k):
                continue
            o1 = (c0[k] + np.arange(len(k)) - np.repeat(np.cumsum(cells) - cells, cells)) * width
            p, lower, upper = at[k], np.maximum(s0[k], at[k] - o1 - width + 1), np.minimum(s1[k], at[k] - o1)
            hashes = mix(window_hashes(grams, p - o1, core) + o1.astype(np.uint64))
            yield hashes, _string_hashes(grams, lower, upper, p, threshold), ids[row[k]], texts[row[k]], lower - base[k], upper - lower + 1, p - lower


def _repeats(batches: Iterator[pa.RecordBatch], refine: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, b, doc_id, h, s) to those that repeat.

    refine: also the first of each b where a has several, and the first of each further text of that row's id, which
    repeats nothing here either.
    """
    held: list[np.ndarray] | None = None  # the first row of the (a, b) of the last row so far
    text = None  # doc_id, h and s of the first row of the last row's text in its (a, b)
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, doc, h, s, n, o = (batch.column(k).to_numpy() for k in range(7))
        known = batch.column(7).to_numpy(zero_copy_only=False)
        out = []
        if held is not None:  # the held row's (a, b) goes on: rows are compared with its first row
            a, b, doc, h, s, n, o = (np.concatenate([[old], x]) for old, x in zip(held[:7], (a, b, doc, h, s, n, o), strict=True))
            known = np.concatenate([[held[7]], known])
        same_a = np.zeros(len(a), bool)
        same_a[1:] = (a[1:] == a[:-1]) & ~known[1:] & ~known[:-1]
        same = same_a.copy()
        same[1:] &= b[1:] == b[:-1]
        head = np.flatnonzero(~same)
        first = np.repeat(head, np.diff(np.append(head, len(a))))
        begins = ~same  # the first row of each text
        begins[1:] |= (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        own = np.flatnonzero(begins)
        place = s[own]
        if held is not None and len(a) > 1 and same[1] and begins[1] and (doc[1], h[1]) == text[:2]:
            begins[1], place[1] = False, text[2]  # the text of the last batch's last row goes on
        place = np.repeat(place, np.diff(np.append(own, len(a))))
        repeat = known | (same & ((doc != doc[first]) | (s != place)))
        if held is not None:
            repeat[0] = False
        out.append((doc[repeat], h[repeat], s[repeat], n[repeat], o[repeat], np.zeros(int(repeat.sum()), bool)))
        if refine:
            starts_b = np.zeros(len(a), bool)
            starts_b[1:] = same_a[1:] & ~same[1:]  # another string of the same anchor begins here
            again = np.zeros(len(a), bool)
            again[head] = starts_b[head]
            follows = head[1:][starts_b[head[1:]]]
            before = first[follows - 1]
            again[before] = True
            if held is not None:
                again[0] = again[0] and not held[8]  # told already
            again &= ~repeat
            told = bool(again[first[-1]] or (first[-1] == 0 and held is not None and held[8]))
            again |= begins & same & ~repeat
            out.append((doc[again], h[again], s[again], n[again], o[again], np.ones(int(again.sum()), bool)))
        else:
            told = False
        f = first[-1]
        held = [a[f], b[f], doc[f], h[f], s[f], n[f], o[f], known[f], told]
        text = doc[-1], h[-1], place[-1]
        cols = [np.concatenate(x) for x in zip(*out, strict=True)]
        if len(cols[0]):
            yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3].astype(np.int32)), pa.array(cols[4].astype(np.int32)), pa.array(cols[5])], schema=_FOUND)


def _pass(rows: DataFrame, refine: bool) -> DataFrame:
    return rows.repartition("a").sortWithinPartitions("a", "b", "doc_id", "h", "s").mapInArrow(lambda it: _repeats(it, refine), FOUND)


def repeated_windows(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, h (hash of the text) and runs (array of s, n): the windows that also start earlier, by their starts. Only documents that have some."""
    rows = keyed_texts(docs).withColumnRenamed("text_hash", "h")
    found = cut(_pass(rows.mapInArrow(lambda it: _thinned(_anchor_rows(it, threshold)), ROWS), True))

    def deeper(found: DataFrame, width: int, refine: bool) -> DataFrame:
        fine = found.where("fine").groupBy("doc_id", "h").agg(F.collect_list(F.struct("s", "n", "o")).alias("runs"))
        wanted = rows.join(fine.hint("merge"), ["doc_id", "h"]).select("doc_id", "h", "text", "runs")
        return _pass(wanted.mapInArrow(lambda it: _thinned(_cell_rows(it, threshold, width)), ROWS), refine)

    by_cell = deeper(found, min(CELL, threshold - GRAM + 1), True)
    by_window = deeper(by_cell, 1, False)
    settled = [x.where("NOT fine").select("doc_id", "h", "s", "n") for x in (found, by_cell, by_window)]
    return settled[0].unionByName(settled[1]).unionByName(settled[2]).groupBy("doc_id", "h").agg(F.collect_list(F.struct("s", "n")).alias("runs"))


def _apply(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
    for batch in batches:
        ids = batch.column(0).to_pylist()
        off, data = text_bytes(batch.column(1))
        first, (starts, counts) = _runs(batch.column(2), "sn")
        for lo, hi in slices(off, 1 << 22):
            out = []
            for k in range(lo, hi):
                text = data[off[k] : off[k + 1]]
                part = slice(first[k], first[k + 1])
                if first[k] == first[k + 1]:
                    out.append((ids[k], len(text), 0, [], [], text.tobytes()))
                    continue
                s = np.minimum(starts[part], len(text))
                change = np.bincount(s, minlength=len(text) + 1) - np.bincount(np.minimum(s + counts[part] + threshold - 1, len(text)), minlength=len(text) + 1)
                gone = np.cumsum(change)[:-1] > 0
                edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
                out.append((ids[k], len(text), int(gone.sum()), np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), text[~gone].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "span_starts", "span_ends", "kept"])


def dedup(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, span_starts, span_ends (maximal removed runs), kept (the bytes left)."""
    rows = keyed_texts(docs).withColumnRenamed("text_hash", "h")
    joined = rows.join(repeated_windows(docs, threshold).hint("merge"), ["doc_id", "h"], "left").select("doc_id", "text", "runs")
    return restored(joined.mapInArrow(lambda it: _apply(it, threshold), "doc_id bigint, n_bytes bigint, n_removed bigint, span_starts array<bigint>, span_ends array<bigint>, kept binary"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dedup(read(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_bytes", "n_removed", F.size("span_starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list[tuple[int, bytes]], threshold: int = THRESHOLD) -> list[tuple]:
    """The same result by a table of all windows, for tests."""
    seen, fresh, last, out = set(), set(), None, []
    for doc_id, text in sorted(docs):
        if doc_id != last:  # texts of one id take nothing from each other
            seen, fresh, last = seen | fresh, set(), doc_id
        gone, own = np.zeros(len(text), bool), set()
        for s in range(len(text) - threshold + 1):
            w = text[s : s + threshold]
            if w in seen or w in own:
                gone[s : s + threshold] = True
            own.add(w)
        fresh |= own
        edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(text), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out
