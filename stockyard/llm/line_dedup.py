"""Removal of repeated runs of lines by winnowing over line hashes.

Lines are compared without surrounding white space; lines without a word are skipped. A window is the shortest run of
lines that holds MIN_WORDS words and starts, or ends, at a line, so a long line is a window of its own and short lines
need company.

1. Each window selects its least line hash, the last of equal ones, as fingerprint. Texts that share a window select the
   same line of it, so fingerprints are guaranteed for every shared run of MIN_WORDS words; neighbouring windows mostly
   select the same line, which is one row.
2. Places of equal fingerprints are joined; fingerprints with one place leave here, with all their windows.
3. Matches are extended to both sides window by window: of the windows around the fingerprints that are left, equal ones
   are grouped, and all but the first (smallest doc_id, text hash, line) are deleted.

Of any run with MIN_WORDS words that stands at an earlier place too, this deletes every line: the lines up to the end of
the window that starts the run are in it, and at each later line a window of the run ends. So a run is held against all
earlier places, not against one partner. Short repeated lines alone stay, and so do lines without a word between two
lines that are windows of their own.

A null or empty text has no lines; a null id is the smallest id. Rows are told apart by id and text hash: texts that share
an id, or have none, are documents of their own; rows equal in both are one document given twice. A text without removals
is returned as it is; very long texts are rows like others. Extra columns are ignored by `runs` and kept by `dedup_lines`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, keyed_texts, read, restored, row_keys, text_bytes, with_group

MIN_WORDS = 20
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

FINGERPRINTS = "fp bigint, doc_id bigint, text_hash bigint, place int, windows array<struct<window:bigint,line:int,n:int>>"
KEY = ["doc_id", "text_hash"]


def line_hashes(text: bytes) -> tuple[list[int], list[int], list[int]]:
    """Of the lines with a word: place, signed 64-bit hash, words."""
    import xxhash

    places, hashes, counts = [], [], []
    for k, line in enumerate(text.split(b"\n")):
        n = len(line.split())
        if n:
            places.append(k)
            hashes.append(xxhash.xxh3_64_intdigest(line.strip()) - 2**63)
            counts.append(n)
    return places, hashes, counts


def windows(hashes: list[int], counts: list[int], min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, int]]:
    """(first line, lines, place of the fingerprint) of each window, once: those by first line, then those that only end at a line."""
    total, ends, end = [0, *accumulate(counts)], [], 0
    least = lambda i, end: i if end == i + 1 else end - 1 - hashes[i:end][::-1].index(min(hashes[i:end]))
    for i in range(len(hashes)):
        while end < len(hashes) and total[end] - total[i] < min_words:
            end += 1
        if total[end] - total[i] < min_words:
            break
        ends.append(end)
        yield i, end - i, least(i, end)
    i = 0
    for end in range(ends[0] if ends else len(total), len(total)):
        while total[end] - total[i + 1] >= min_words:
            i += 1
        if ends[i] != end:
            yield i, end - i, least(i, end)


def _fingerprints(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        ids = [batch.column(k).to_pylist() for k in (0, 1)]
        off, data = text_bytes(batch.column(2))
        rows, inner, sizes = [], [], []
        for k, key in enumerate(zip(*ids, strict=True)):
            _, hashes, counts = line_hashes(data[off[k] : off[k + 1]].tobytes())
            raw = np.array(hashes, np.int64)
            held: dict[int, list[tuple[int, int, int]]] = {}
            for i, n, place in windows(hashes, counts, min_words):
                held.setdefault(place, []).append((xxhash.xxh3_64_intdigest(raw[i : i + n].tobytes(), seed=n) - 2**63, i, n))
            for place, found in held.items():
                rows.append((hashes[place], *key, place))
                sizes.append(len(found))
                inner += found
        if rows:
            fields = [pa.array(c, t) for c, t in zip(zip(*inner, strict=True), (pa.int64(), pa.int32(), pa.int32()), strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.StructArray.from_arrays(fields, ["window", "line", "n"]))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, lists], names=["fp", *KEY, "place", "windows"])


def runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_hash and spans (array of line, n, source, source_line): windows that stand at an earlier place too, in lines that hold a word."""
    rows = keyed_texts(docs).mapInArrow(lambda it: _fingerprints(it, min_words), FINGERPRINTS)
    several = F.count(F.lit(1))
    met = with_group(rows, ["fp"], [*KEY, "place"], [several.alias("times")], "times > 1")
    around = cut(met.select("fp", *KEY, F.explode("windows").alias("w")).select("fp", "w.window", *KEY, "w.line", "w.n"))
    place = F.struct(*KEY, "line")
    again = with_group(around, ["fp", "window"], [*KEY, "line"], [several.alias("times"), F.min(place).alias("first")], "times > 1").where(place != F.col("first"))
    found = again.select(*KEY, F.struct("line", "n", F.col("first.doc_id").alias("source"), F.col("first.line").alias("source_line")).alias("span"))
    return found.groupBy(*KEY).agg(F.sort_array(F.collect_set("span")).alias("spans"))


#: Rows whose texts are rewritten together.
ROWS = 256


def without_runs(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, list[tuple[int, int]]]:
    """The text without the spans (in lines that hold a word), the lines with a word that went, and the line ranges."""
    if not spans:
        return text, 0, []
    lines = text.split(b"\n")
    places = [i for i, line in enumerate(lines) if line.split()]
    gone = np.zeros(len(lines) + 1, bool)
    for s in spans:
        a, b = s["line"], min(s["line"] + s["n"], len(places))
        if a < b:
            gone[places[a] : places[b - 1] + 1] = True
    edge = np.diff(np.concatenate([[0], gone.view(np.int8)]))
    ranges = [(int(a), int(b)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
    return b"\n".join([line for line, g in zip(lines, gone, strict=False) if not g]), int(sum(gone[i] for i in places)), ranges


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            off, data = text_bytes(part.column(1))
            kept, rest = [], []
            for k, spans in enumerate(part.column(2).to_pylist()):
                text, n, ranges = without_runs(data[off[k] : off[k + 1]].tobytes(), spans)
                kept.append(text)
                rest.append((n, len(ranges), [{"start": a, "end": b} for a, b in ranges]))
            columns = [part.column(0), pa.array(kept, pa.binary()).cast(pa.string())]
            columns += [pa.array(c, t) for c, t in zip(zip(*rest, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "kept", "n_removed", "n_runs", "removed"])


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: doc_id, kept (text), n_removed (lines with a word), n_runs, removed (line ranges)."""
    joined = keyed_texts(docs).join(runs(docs, min_words).hint("merge"), KEY, "left").select("doc_id", "text", "spans")
    return restored(joined.mapInArrow(_apply, "doc_id bigint, kept string, n_removed bigint, n_runs bigint, removed array<struct<start:bigint,end:bigint>>"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with all their columns, text without the repeated runs and n_chars (if there) to match."""
    names, extra = docs.columns, "spans"
    while extra in names:
        extra += "_"

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                columns, spans = list(part.columns[:-1]), part.column(len(names)).to_pylist()
                if any(spans):
                    old = columns[at].to_pylist()
                    new = pa.array([without_runs(t.encode(), s)[0].decode() if s and t else t for t, s in zip(old, spans, strict=True)], columns[at].type)
                    columns[at] = new
                    if chars is not None:
                        changed = pa.array([bool(s) for s in spans])
                        columns[chars] = pc.if_else(changed, pc.utf8_length(new).cast(columns[chars].type), columns[chars])
                yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = row_keys(docs).join(runs(docs, min_words).hint("merge"), KEY, "left").select("row.*", F.col("spans").alias(extra))
    return joined.mapInArrow(rewrite, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.length("kept").cast("long").alias("n_chars_kept"), "n_removed", "n_runs", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list[tuple[int | None, str | None]], min_words: int = MIN_WORDS) -> list[tuple[int | None, str]]:
    """(id, kept text) by comparing every line with all earlier places along both texts, for tests."""
    import xxhash

    rows = {(-(2**63) if i is None else i, (xxhash.xxh64_intdigest((t or "").encode(), 42) + 2**63) % 2**64 - 2**63): t or "" for i, t in docs}
    every = {i: [(k, x.strip(" \t\n\v\f\r"), len(x.split())) for k, x in enumerate(t.split("\n")) if re.search(r"[^ \t-\r]", x)] for i, t in rows.items()}
    places: dict[str, list[tuple]] = {}
    out = []
    for i, text in sorted(rows.items()):
        lines, gone = every[i], set()
        for a in range(len(lines)):
            for j, c in places.get(lines[a][1], []):
                n = 0
                if a and c and lines[a - 1][1] == every[j][c - 1][1]:
                    continue  # within the match that starts further left
                while a + n < len(lines) and c + n < len(every[j]) and lines[a + n][1] == every[j][c + n][1]:
                    n += 1
                if sum(x[2] for x in lines[a : a + n]) < min_words:
                    continue
                gone |= {x[0] for x in lines[a : a + n]}
                for x, y in zip(lines[a : a + n - 1], lines[a + 1 : a + n], strict=True):
                    if min(x[2], y[2]) < min_words:  # lines without a word between them
                        gone |= set(range(x[0], y[0]))
            places.setdefault(lines[a][1], []).append((i, a))
        out.append((None if i[0] == -(2**63) else i[0], "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)))
    return out
