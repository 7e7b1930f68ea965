"""Toxicity by multiple-instance learning: documents are bags of sentences, joined by noisy-or.

A sentence's score is the logistic of a fixed negative bias plus the weights of its words' features, and 0 if it has none
of the model's features, so length alone is no evidence; a document is toxic if any sentence is:
score = 1 - prod(1 - sentence score). Only documents have labels. Features are the first 4
to 8 bytes of a word in lower case (A-Z), its first 4 to 8 characters if some are not ASCII, and the whole word, by
64-bit hash. The fit takes the labelled
rows whose crc32(doc_id as text) mod 3 is not 1, at most MAX_LABELLED of them in the order of a hash of their id; it
keeps the features that a likelihood-ratio test finds in toxic documents and maximises the noisy-or likelihood over
their weights. Scoring covers every text whole; the model is at most MAX_FEATURES hashes and weights.

Labels, lang, source and doc_id are no inputs of a score. A null or empty text has no sentence and scores 0. Without
labels of both kinds no feature is kept and scores are 0. Repeated labels of an id count as toxic if any is; null
labels are ignored. Repeated rows are scored each; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, keep_rows, mix, read, restored, slices, text_bytes, texts, word_hashes, word_spans

MAX_LABELLED = 5000
MAX_FEATURES = 4000
BIAS = -12.0
THRESHOLD = 0.7
#: A sentence with at least this score is reported as offending.
OFFENDING = 0.5

#: Bytes between words: ASCII other than letters and digits.
GAPS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
STOPS = np.zeros(256, bool)
STOPS[[0x0A, *b".!?"]] = True
PREFIXES = (4, 5, 6, 7, 8)


@dataclass
class Model:
    """Sorted feature hashes and their weights."""

    hashes: np.ndarray
    weights: np.ndarray

    def __post_init__(self):
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.hashes >> np.uint64(44)] = True

    def of(self, features: np.ndarray) -> np.ndarray:
        """The place of each feature, -1 if unknown."""
        out = np.full(len(features), -1, np.int64)
        maybe = np.flatnonzero(self.sieve[features >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.hashes, features[maybe]), max(0, len(self.hashes) - 1))
        good = self.hashes[at] == features[maybe] if len(self.hashes) else np.zeros(len(maybe), bool)
        out[maybe[good]] = at[good]
        return out


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: start, first eight bytes as an integer, length; A-Z in lower case."""
    data = LOWER[data]
    starts, ends = word_spans(data, bounds, GAPS)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    head = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))[starts]
    return starts, head, ends - starts


def word_features(head: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words that have it, hash) for each kind of feature."""
    whole = np.flatnonzero(length <= 8)
    if len(whole):
        bits = (np.uint64(64) - length[whole].astype(np.uint64) * np.uint64(8)) & np.uint64(63)
        yield whole, mix((head[whole] << bits >> bits) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(99))
    for k in PREFIXES:
        some = np.flatnonzero(length >= k)
        if len(some):
            bits = np.uint64(64 - 8 * k)
            yield some, mix((head[some] << bits >> bits) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))


def all_features(data: np.ndarray, starts: np.ndarray, head: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Those of word_features, whole words beyond eight bytes, and prefixes in characters of words that are not ASCII."""
    yield from word_features(head, length)
    data = LOWER[data]
    some = np.flatnonzero(length > 8)
    if len(some):
        yield some, mix(word_hashes(data, starts[some], starts[some] + length[some]) + np.uint64(100))
    leads = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))
    first, end = np.searchsorted(leads, starts), np.searchsorted(leads, starts + length)
    for k in PREFIXES:
        some = np.flatnonzero((end - first < length) & (end - first >= k))
        if len(some):
            yield some, mix(word_hashes(data, starts[some], leads[first[some] + k]) + np.uint64(100 + k))


def sentences(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of the sentences that hold each word, and each sentence's first word. A sentence is in one text."""
    stops = np.cumsum(STOPS[data])
    mark = np.where(starts > 0, stops[starts - 1], 0) if len(starts) else np.zeros(0, np.int64)
    row = np.searchsorted(bounds, starts, "right") - 1
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])
    return np.cumsum(fresh) - 1, np.flatnonzero(fresh)


def noisy_or(weights: np.ndarray, feature: np.ndarray, sentence: np.ndarray, n_sentences: int) -> np.ndarray:
    """log(1 - sentence score), per sentence; 0 for a sentence without a feature."""
    z = BIAS + np.bincount(sentence, weights=weights[feature], minlength=n_sentences)
    return np.where(np.bincount(sentence, minlength=n_sentences) > 0, -np.logaddexp(0.0, z), 0.0)


def fit_rows(texts_: list[bytes], toxic: np.ndarray) -> Model:
    """Fit on a bounded list of texts and their labels."""
    empty = Model(np.zeros(0, np.uint64), np.zeros(0))
    n_pos, n_neg = int(toxic.sum()), int((1 - toxic).sum())
    if not n_pos or not n_neg:
        return empty
    found: dict[str, list] = {"hash": [], "n": [], "pos": []}

    def merge(hashes, n, pos):
        order = np.argsort(hashes, kind="stable")
        hashes, n, pos = hashes[order], n[order], pos[order]
        at = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        return (hashes[at], np.add.reduceat(n, at), np.add.reduceat(pos, at)) if len(at) else (hashes, n, pos)

    parts, held = [], 0
    for text, y in zip(texts_, toxic, strict=True):
        data = np.frombuffer(text, np.uint8)
        f = [h for _, h in all_features(data, *words_of(data, np.array([0, len(data)])))]
        if f:
            u = np.unique(np.concatenate(f))
            parts.append((u, np.ones(len(u), np.int32), np.full(len(u), int(y), np.int32)))
            held += len(u)
        if held > 500_000:
            parts, held = [merge(*map(np.concatenate, zip(*parts, strict=True)))], 0
    if not parts:
        return empty
    hashes, n, pos = merge(*map(np.concatenate, zip(*parts, strict=True)))
    rate = n_pos / (n_pos + n_neg)
    share = np.clip(pos / n, 1e-9, 1 - 1e-9)
    gain = 2 * (pos * np.log(share / rate) + (n - pos) * np.log((1 - share) / (1 - rate)))
    good = np.flatnonzero((share > rate) & (pos >= 3) & (share > 0.5) & (gain > 2 * np.log(len(hashes)) + 4))
    good = good[np.argsort(-gain[good], kind="stable")][:MAX_FEATURES]
    model = Model(np.sort(hashes[good]), np.zeros(len(good)))
    if not len(good):
        return model
    feature, sentence, doc_of = [], [], []
    for k, text in enumerate(texts_):
        data = np.frombuffer(text, np.uint8)
        bounds = np.array([0, len(data)])
        starts, head, length = words_of(data, bounds)
        number, _ = sentences(data, bounds, starts)
        mine = [(model.of(h), w) for w, h in all_features(data, starts, head, length)]
        f = np.concatenate([a for a, _ in mine]) if mine else np.zeros(0, np.int64)
        s = number[np.concatenate([w for _, w in mine])] if mine else f
        pairs = np.unique(np.stack([s[f >= 0], f[f >= 0]]), axis=1)
        some, local = np.unique(pairs[0], return_inverse=True)
        feature.append(pairs[1])
        sentence.append(local + len(doc_of))
        doc_of += [k] * len(some)
    feature, sentence, doc_of = np.concatenate(feature).astype(int), np.concatenate(sentence).astype(int), np.array(doc_of, int)
    weights, m, v = np.full(len(good), 2.0), np.zeros(len(good)), np.zeros(len(good))
    for step in range(1, 301):  # Adam on the log-likelihood of the bags, with a small ridge
        z = BIAS + np.bincount(sentence, weights=weights[feature], minlength=len(doc_of))
        p = 1 / (1 + np.exp(-z))
        log_none = np.bincount(doc_of, weights=-np.logaddexp(0.0, z), minlength=len(texts_))
        none = np.exp(log_none)
        pull = np.where(toxic == 1, none / np.maximum(1 - none, 1e-6), -1.0)
        grad = np.bincount(feature, weights=(pull[doc_of] * p)[sentence], minlength=len(good)) - 0.02 * weights
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        weights = weights + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.weights = weights
    return model


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled rows that are not held out; at most MAX_LABELLED, by the hash of their id."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    sample = texts(docs).join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]).select("text", "toxic")

    def run(batches):
        rows, marks = [], []
        for batch in batches:
            off, data = text_bytes(batch.column(0))
            rows += [data[off[k] : off[k + 1]].tobytes() for k in range(batch.num_rows)]
            marks += batch.column(1).to_pylist()
        model = fit_rows(rows, np.array(marks, int))
        yield pa.RecordBatch.from_arrays([pa.array(model.hashes.view(np.int64)), pa.array(model.weights)], names=["hash", "weight"])

    rows = sample.coalesce(1).mapInArrow(run, "hash bigint, weight double").collect()
    hashes = np.array([r["hash"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Model(hashes[order], np.array([r["weight"] for r in rows], float)[order])


def held_out(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    for batch in batches:
        off, data = text_bytes(batch.column(1))
        for lo, hi in slices(off):
            part, bounds = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
            starts, head, length = words_of(part, bounds)
            number, firsts = sentences(part, bounds, starts)
            hits = [(model.of(h), w) for w, h in all_features(part, starts, head, length)] if len(model.hashes) else []
            f = np.concatenate([a[a >= 0] for a, _ in hits]) if hits else np.zeros(0, np.int64)
            s = np.concatenate([number[w[a >= 0]] for a, w in hits]) if hits else np.zeros(0, np.int64)
            pairs = np.unique(s * MAX_FEATURES + f)
            none = noisy_or(model.weights if len(model.weights) else np.zeros(1), pairs % MAX_FEATURES, pairs // MAX_FEATURES, len(firsts))
            row = np.searchsorted(bounds, starts[firsts], "right") - 1
            score = 1 - np.exp(np.bincount(row, weights=none, minlength=hi - lo))
            spans = [[] for _ in range(hi - lo)]
            for k in np.flatnonzero(-np.expm1(none) >= OFFENDING):
                last = firsts[k + 1] - 1 if k + 1 < len(firsts) else len(starts) - 1
                spans[row[k]].append({"start": int(starts[firsts[k]] - bounds[row[k]]), "end": int(starts[last] + length[last] - bounds[row[k]]), "score": float(-np.expm1(none[k]))})
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.clip(score, 0.0, 1.0)), pa.array(spans, span)], names=["doc_id", "score", "offending"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, offending: byte spans of the sentences at fault, with their scores."""
    out = texts(docs).mapInArrow(lambda it: _score(it, model), "doc_id bigint, score double, offending array<struct<start:bigint,end:bigint,score:double>>")
    return restored(out)


def clean_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with all their columns that score under the threshold."""
    return keep_rows(docs, lambda it: (pa.array(b.column(1).to_numpy() < threshold) for b in _score(it, model)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("offending").cast("long").alias("n_offending"))
