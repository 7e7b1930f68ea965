"""Packing into sequences by an order-preserving dynamic program.

The documents of one input partition form a stream of ids in their order. Cuts may fall at document ends (free), after
a sentence end (SENTENCE), or elsewhere where boundaries are far apart (HARD); a sequence [a, b) costs its padding plus
the penalty of the cut at b. Padding is up to `size`, or none if the length is a power of two. The best cuts are
found from left to right: the cheapest start within `size` ids is the front of a monotone queue of f(a) + a, and the
power-of-two lengths are looked up by place. A stream is solved in windows of WINDOW ids; the last sequences of a
window are left to the next one, so memory does not depend on the partition.

Every id lies in exactly one piece, and there is no shuffle: partitions are packed apart, and each ends with one
sequence that may need padding. A null or empty text is the end id alone; repeated rows are packed each; extra columns
are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .bit_planes import END_ID, TOKENIZER, encoder
from .common import read, restored, text_bytes, texts

SIZE = 2048
SENTENCE = 4
HARD = 48
SEQUENCE = 1
#: Ids between places where a cut is allowed, at most.
REACH = 128
WINDOW = 1 << 18

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, cut string"


def padding(length: int, size: int = SIZE) -> int:
    return 0 if length & (length - 1) == 0 else size - length


def best_cuts(places: list[int], penalties: list[int], size: int = SIZE) -> list[int]:
    """Indices of the cuts of least cost from places[0] to places[-1]; neighbours are at most `size` apart."""
    n = len(places)
    cost, back = [0] * n, [0] * n
    where = {p: k for k, p in enumerate(places)}
    queue: deque[tuple[int, int, int]] = deque([(places[0], places[0], 0)])
    powers = [1 << k for k in range(size.bit_length() - 1, -1, -1) if 1 << k <= size]
    for j in range(1, n):
        p = places[j]
        while p - queue[0][1] > size:
            queue.popleft()
        best, _, source = queue[0]
        best += size - p
        for step in powers:
            i = where.get(p - step)
            if i is not None and cost[i] < best:
                best, source = cost[i], i
        best += penalties[j] + SEQUENCE
        cost[j], back[j] = best, source
        key = best + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    out, j = [], n - 1
    while j > 0:
        out.append(j)
        j = back[j]
    return out[::-1]


def candidates(ids: np.ndarray, ends: np.ndarray, sentence_end: np.ndarray, size: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of allowed cuts in a stream and their penalties; 0 and the stream's end are among them."""
    n = len(ids)
    cost = np.full(n + 1, HARD + 1, np.int16)
    cost[1:][sentence_end[ids]] = SENTENCE
    cost[ends] = 0
    cost[[0, n]] = 0
    at = np.flatnonzero(cost <= HARD)
    wide = np.flatnonzero(np.diff(at) > min(REACH, size))
    for a, b in zip(at[wide], at[wide + 1], strict=True):
        cost[np.arange(a + min(REACH, size), b, min(REACH, size))] = HARD
    if last:  # the rest before the end in lengths that are powers of two
        rest, place = n % size, n
        for k in range(size.bit_length()):
            if rest >> k & 1:
                place -= 1 << k
                cost[place] = min(cost[place], HARD)
    at = np.flatnonzero(cost <= HARD)
    return at, cost[at]


def _pack(batches: Iterator[pa.RecordBatch], tokenizer: str, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    enc, end = encoder(tokenizer), np.array([END_ID], "<u4").tobytes()
    vocabulary = enc.tokenizer.get_vocab()
    sentence_end = np.zeros(max(vocabulary.values()) + 2, bool)
    sentence_end[[i for t, i in vocabulary.items() if t.endswith((".</w>", "!</w>", "?</w>"))]] = True
    sequence = TaskContext.get().partitionId() << 33
    held, docs = bytearray(), deque()  # docs: id, first id in the held stream (may be negative), ids
    kinds = {0: "document", SENTENCE: "sentence", HARD: "hard"}

    def flush(last: bool) -> list[tuple]:
        nonlocal held, sequence
        ids = np.frombuffer(bytes(held), "<u4")
        ends = np.array([d[1] + d[2] for d in docs], np.int64)
        at, cost = candidates(ids, ends[ends <= len(ids)], sentence_end, size, last)
        places, penalties = at.tolist(), cost.tolist()
        cuts = best_cuts(places, penalties, size)
        if not last:
            cuts = cuts[: max(1, len(cuts) - 8)]
        out, a, raw = [], 0, memoryview(bytes(held))
        for c in cuts:
            b = places[c]
            x = a
            while x < b:
                doc_id, first, n = docs[0]
                y = min(b, first + n)
                out.append((doc_id, x - first, y - x, zlib.crc32(raw[4 * x : 4 * y]), n, sequence, x - a, kinds[penalties[c]]))
                if y == first + n:
                    docs.popleft()
                x = y
            a, sequence = b, sequence + 1
        held = held[4 * a :]
        for k, (doc_id, first, n) in enumerate(docs):
            docs[k] = (doc_id, first - a, n)
        return out

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        off, data = text_bytes(batch.column(1))
        text = memoryview(data)
        for k, doc_id in enumerate(doc_ids):
            tokens = enc.encode(bytes(text[off[k] : off[k + 1]])) + end
            docs.append((doc_id, len(held) // 4, len(tokens) // 4))
            held += tokens
            if len(held) >= 4 * WINDOW:
                yield batch_of(flush(False))
    enc.forget()
    if held:
        yield batch_of(flush(True))


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, size: int = SIZE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cut (kind of the sequence's end)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(SCHEMA))
    return restored(texts(docs).mapInArrow(lambda it: _pack(it, tokenizer, size, schema), SCHEMA))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
