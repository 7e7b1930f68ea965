"""Parts of the training-data operators that need no Spark."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockyard.llm import bit_planes, common, decontaminate, license_scan, packing, shingles, suffix_kernel, toxicity, warc

TEXT = st.text(st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=300), st.sampled_from(["byte", "bit"]))
def test_planes_round_trip(ids, mode):
    raw = np.array(ids, np.uint32)
    sizes, planes = bit_planes.to_planes(raw, mode)
    assert len(sizes) == (4 if mode == "byte" else 32) and sum(sizes) == len(planes)
    assert bit_planes.from_planes(sizes, planes, len(ids), mode).tolist() == ids


@given(st.binary(max_size=50), st.binary(max_size=300))
def test_crc32_combine(a, b):
    assert bit_planes.crc32_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


WORDS = ["word", "Word,", "naïve", "ÉTÉ.", "it's", "won't've", "x%%%", "a.b", "<|endoftext|>", "ﬁ", "12", "3.5", "日本語", "é", "İ", "ΣΑΣ", "don’t", "a b", "\x1c", "z\x85y", "-", "...", "9th", "ß", "ÿ×÷", "Ünïçödé!?", "q" * 100]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(WORDS), TEXT), max_size=20), st.sampled_from([" ", "\n", "\t ", "\r\n", "\x0b\x0c"]))
def test_word_encoder_equals_library(words, space):
    enc = bit_planes.encoder(bit_planes.TOKENIZER)
    text = space.join(words)
    want = enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(enc.encode(text.encode()), "<u4").tolist() == want


@given(st.lists(st.integers(1, 30), min_size=2, max_size=40), st.sampled_from([32, 64]))
def test_cuts_are_optimal(gaps, size):
    places = [0, *np.cumsum(gaps).tolist()]
    penalties = [0] + [(k * 7) % 5 for k in range(1, len(places))]
    cuts = packing.best_cuts(places, penalties, size)
    cost = lambda c: sum(packing_cost(places[b] - places[a], size) + penalties[b] + packing.SEQUENCE for a, b in zip([0, *c[:-1]], c, strict=True))

    best = [0] + [10**9] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= size:
                best[j] = min(best[j], best[i] + packing_cost(places[j] - places[i], size) + penalties[j] + packing.SEQUENCE)
    assert cuts[-1] == len(places) - 1 and cost(cuts) == best[-1]


def packing_cost(length, size):
    return 0 if length in {2**k for k in range(12)} else size - length


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.lists(st.integers(0, 3), max_size=30))
def test_myers_equals_table(pattern, text):
    column = list(range(len(pattern) + 1))
    best = column[-1]
    for x in text:
        diagonal, column[0] = column[0], 0
        for k in range(1, len(pattern) + 1):
            diagonal, column[k] = column[k], min(column[k] + 1, column[k - 1] + 1, diagonal + (x != pattern[k - 1]))
        best = min(best, column[-1])
    assert decontaminate.myers(np.array(pattern), np.array(text))[0] == best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=8), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=20))
def test_matching_statistics(strings, text):
    automaton = license_scan.SuffixAutomaton(strings)
    parts = {tuple(s[a:b]): None for s in strings for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    for j, (state, length) in enumerate(automaton.statistics(text)):
        want = max((n for n in range(1, j + 2) if tuple(text[j + 1 - n : j + 1]) in parts), default=0)
        assert length == want
        if length:
            found = tuple(text[j + 1 - length : j + 1])
            assert automaton.ends[state] == {(t, e) for t, s in enumerate(strings) for e in range(len(s)) if tuple(s[max(0, e - length + 1) : e + 1]) == found}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab Z\n\té.", max_size=30), max_size=6), st.integers(1, 4))
def test_shingle_sets(texts, words):
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    hashes, at = shingles.shingle_sets(np.frombuffer(b"".join(data), np.uint8), bounds, words)
    seen = {}
    for k, t in enumerate(data):
        w = t.lower().split()
        want = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
        got = hashes[at[k] : at[k + 1]].tolist()
        assert len(got) == len(want)
        seen.setdefault(frozenset(want), set(got))
        assert seen[frozenset(want)] == set(got)
    values = list(seen.values())
    assert all(len(values[a] & values[b]) == len(list(seen)[a] & list(seen)[b]) for a in range(len(values)) for b in range(a))


def test_anchors_are_the_same_for_equal_windows():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"abc ") for _ in range(rng.choice([0, 20, 99, 100, 400]))) for _ in range(12)]
    texts += [b"x" * 30 + texts[4] + b"yy", b"a" * 300]
    bounds = np.cumsum([0, *map(len, texts)])
    data = b"".join(texts)
    grams, s0, s1, at = suffix_kernel.anchors(np.frombuffer(data, np.uint8), bounds, 100)
    anchor_of, covered = {}, set()
    for a, b, p in zip(s0.tolist(), s1.tolist(), at.tolist(), strict=True):
        for s in range(a, b + 1):
            covered.add(s)
            assert s <= p <= s + 68
            assert anchor_of.setdefault(data[s : s + 100], p - s) == p - s
    assert covered == {s for k, t in enumerate(texts) for s in range(bounds[k], bounds[k] + len(t) - 99)}


def test_word_spans_stop_at_bounds():
    data = np.frombuffer(b"ab cd", np.uint8)
    starts, ends = common.word_spans(data, np.array([0, 1, 1, 4, 5]))
    assert list(zip(starts, ends, strict=True)) == [(0, 1), (1, 2), (3, 4), (4, 5)]


def test_toxicity_fit_finds_words_and_sentences():
    rng = random.Random(1)
    words = [f"word{k}" for k in range(300)]
    make = lambda bad: ". ".join(" ".join(rng.choices(words, k=8) + ["moronic"] * (bad and s == 1)) for s in range(4)).encode()
    labels = np.array([k % 4 == 0 for k in range(400)], int)
    model = toxicity.fit_rows([make(bool(y)) for y in labels], labels)
    assert len(model.hashes) and model.weights.max() > 1
    assert len(toxicity.fit_rows([b"a b"], np.array([1])).hashes) == 0


def test_toxicity_of_a_clean_text_does_not_grow_with_its_length():
    model = toxicity.Model(np.sort(np.concatenate([h for _, h in toxicity.word_features(*toxicity.words_of(np.frombuffer(b"moronic", np.uint8), np.array([0, 7]))[1:])])), np.full(5, 4.0))
    texts = ["word\n" * 300_000, "3.14 " * 150_000, "word\n" * 300_000 + "a moronic line", "", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array([t or "" for t in texts])], names=["doc_id", "text"])
    rows = [r for out in toxicity._score(iter([batch]), model) for r in out.to_pylist()]
    assert [r["score"] for r in rows] == [0.0, 0.0, pytest.approx(1 / (1 + np.exp(-8.0))), 0.0, 0.0]
    assert [len(r["offending"]) for r in rows] == [0, 0, 1, 0, 0]
    long = [b"word\n" * 300_000 + (b"a moronic line" if y else b"") for y in (1, 1, 1, 1, 0, 0, 0, 0)]
    short = [b"some words here" for _ in range(40)]
    assert toxicity.fit_rows(long + short, np.array([1] * 4 + [0] * 44)).weights.max() > 1


def test_toxicity_tells_words_apart_beyond_eight_bytes():
    for good, bad in (("communication", "communicators"), ("глупости", "глупцами"), ("मूर्खता", "मूर्तियाँ")):
        texts = [f"this is {bad if k % 4 == 0 else good} here".encode() for k in range(200)]
        model = toxicity.fit_rows(texts, np.array([k % 4 == 0 for k in range(200)], int))
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([f"a {good}", f"a {bad}"])], names=["doc_id", "text"])
        low, high = [r["score"] for out in toxicity._score(iter([batch]), model) for r in out.to_pylist()]
        assert low < 0.5 < high


def test_warc_records_link_and_parse():
    data = warc.response(7, "http://a.example/\r\nx", "<title>T &amp; t</title><p>One<br>two<script>no</script></p><!-- c --><a href='/x'>l</a>")
    headers, block = warc.parse(data)
    assert headers["warc-type"] == "response" and headers["warc-block-digest"] == warc.digest(block)
    meta, conversion = warc.derivatives(data)
    assert meta["refers_to"] == conversion["refers_to"] == headers["warc-record-id"]
    assert conversion["block"].decode() == "T & t\nOne\ntwo\nl"
    notes = dict(x.split(": ", 1) for x in meta["block"].decode().strip().split("\r\n"))
    assert notes["title"] == "T & t" and notes["links"] == "1" and notes["conversion-record-id"] == conversion["record_id"]
    assert notes["source-payload-digest"] == notes["computed-payload-digest"]
    for row in (meta, conversion):
        again, body = warc.parse(row["record"])
        assert body == row["block"] and again["warc-refers-to"] == headers["warc-record-id"] and again["warc-block-digest"] == warc.digest(body)
    with pytest.raises(ValueError):
        warc.parse(b"GET / HTTP/1.1\r\n\r\n")


def test_warc_bodies_are_decoded():
    import gzip

    page = b"<p>plain words</p>"
    zipped = gzip.compress(page)
    chunked = b"5;x=y\r\n" + zipped[:5] + b"\r\n%x\r\n" % len(zipped[5:]) + zipped[5:] + b"\r\n0\r\n\r\n"
    for head, body in ((b"Content-Encoding: gzip", zipped), (b"Content-Encoding: deflate", zlib.compress(page)), (b"Transfer-Encoding: chunked\r\nContent-Encoding: gzip", chunked), (b"Content-Encoding: gzip", page), (b"Transfer-Encoding: chunked", page)):
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n" + head + b"\r\n\r\n" + body
        rows = warc.derivatives(warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], block))
        assert rows[1]["block"] == b"plain words"


def test_licence_chains_cover_templates():
    scan = license_scan.scanner()
    text = license_scan.TEMPLATES[0][1].replace("deal", "trade")
    data = np.frombuffer(text.lower().encode(), np.uint8)
    starts, ends = common.word_spans(data, np.array([0, len(data)]), license_scan.GAPS)
    number = scan.numbers(common.word_hashes(data, starts, ends))
    matches = []
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (number >= 0).astype(int), [0]])))
    for a, b in zip(edge[::2], edge[1::2], strict=True):
        matches += scan.spans(number[a:b], int(a))
    cover, first, last = scan.chained(matches)[0]
    assert cover >= 0.9 * scan.sizes[0] and first == 0 and last == len(starts) - 1


def _led(members: dict[int, tuple[set[int], int]], own: set[int], parts: int):
    """Batches as near_dup._with_leader reads them, three rows each."""
    blob = lambda x: np.array(sorted(x), "<u8").tobytes()
    rows = [(7, 0, 1, None, blob(own), parts, [], *[None] * 6)] + [(7, 0, 1, b, blob(x), parts, None, root, 1, 2, False, 100, 0) for b, (x, root) in sorted(members.items())]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32()]
    names = ["g", "part", "a", "b", "shingles", "parts", "frequent", "root", "d", "e", "near", "among", "across"]
    for k in range(0, len(rows), 3):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 3], strict=True), kinds, strict=True)], names=names)


@pytest.mark.parametrize(("parts", "most"), [(1, 1000), (1, 5), (2, 1000), (2, 5)])
def test_lone_shingles_leave_early_only_where_all_members_are_seen(parts, most):
    from stockyard.llm import near_dup

    own = set(range(80))
    # 1 and 2 share a shingle and a root, 3 and 4 lack one and have another, of different roots, 5 has no company
    members = {1: (own | {100, 101}, 1), 2: (own | {100, 102}, 1), 3: (own - {1} | {103, 104}, 3), 4: (own - {1} | {103, 105}, 4), 5: (own | {106, 107}, 5)}
    every = [r for b in near_dup._differences(_led(members, own, parts), most) for r in b.to_pylist()]
    out = [r for r in every if r["apart"] is None]
    assert sorted((r["id"], len(r["apart"]) // 2) for r in every if r["apart"]) == sorted((b, len(own ^ x)) for b, (x, _) in members.items())
    by_shingle: dict[int, list[tuple[int, int]]] = {}
    for r in out:
        by_shingle.setdefault(r["key"], []).append((r["id"], r["root"]))
    shared = sorted(sorted(x) for x in by_shingle.values() if len({root for _, root in x}) > 1)
    assert shared == [[(3, 3), (4, 4)]] * 2
    assert len(out) == (4 if (parts, most) == (1, 1000) else 12)
    assert {r["g"] for r in out} == {7}
