"""Filter audit, hard negatives and byte-level BPE: against plain versions, on odd rows and on empty tables."""

import base64
import hashlib
import random
from itertools import permutations

import duckdb
import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from stockyard.llm import byte_bpe, filter_audit, hard_negatives
from tests.llm.conftest import ROWS

WORDS = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in WORDS[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_audit(docs, labels):
    """The five filters, document by document, in each order."""
    least = {}
    ids = lambda i: -(2**63) if i is None else i
    for i, text, _ in docs:
        least[text or ""] = min(ids(i), least.get(text or "", 2**63))
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    masks = []
    for i, text, lang in docs:
        text = text or ""
        w = words_of(text)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": ids(i) > least[text],
        }
        masks.append((lang or "", i, {k for k, v in fails.items() if v}))
    out = {}
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                removed = [m for m in left if f in m[2]]
                left = [m for m in left if f not in m[2]]
                out[part, order, step] = [len(left), len(removed), sum(f in m[2] for m in own if m not in removed and m[2] & set(order[: step - 1])), sum(m[2] == {f} for m in own),
                                          sum(m[1] in good for m in removed), sum(m[1] in toxic for m in removed)]
                total[f] += len(removed)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def audit_rows(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


def test_audit_of_odd_rows(spark, odd, none):
    copies = [(20 + k, "UPPER case & more", "en" if k % 2 else "fr", "s", 1, "x") for k in range(9)] + [(20, "UPPER case & more", "de", "s", 1, "x"), (None, "UPPER case & more", None, "s", 1, "x")]
    docs = odd.unionByName(spark.createDataFrame(copies, odd.schema))
    labels = [(1, 1, 0), (5, 1, 1), (20, 0, 1), (20, 1, None), (21, None, None), (None, 1, 1), (6, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit_rows(filter_audit.audit(docs, table))
    want = plain_audit([(r[0], r[1], r[2]) for r in [*ROWS, *copies]], labels)
    assert got == want and len(got) % 600 == 0
    assert filter_audit.audit(none, table).count() == 0
    assert audit_rows(filter_audit.audit(docs, table.limit(0)))[("", "ABCDE", 1)][4:6] == [0, 0]


def test_audit_equals_oracle(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = filter_audit.query(spark, sf_dir)
    want = con.execute(filter_audit.ORACLE)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())


def test_matrices_tell_every_mask_once():
    columns, by = filter_audit.matrices()
    assert len(columns) == 600 and all(x.shape == (32, 600) for x in by.values())
    for mask in range(32):
        for o in range(120):
            removed = by["removed"][mask, 5 * o : 5 * o + 5]
            assert removed.sum() == (mask > 0) and by["kept"][mask, 5 * o + 4] == (mask == 0)


def plain_negatives(rows, every=100):
    """rows: id, label, integer vector, all distinct."""
    out = set()
    key = lambda s, r: (-s, -(2**63) if r[0] is None else r[0])
    for a in rows:
        if a[0] is None or a[0] % every:
            continue
        scored = [(sum(x * y for x, y in zip(a[2], r[2], strict=True)), r) for r in rows if r is not a and len(r[2]) == len(a[2])]
        positives = sorted(((s, r) for s, r in scored if r[1] == a[1]), key=lambda x: key(*x))[:5]
        negatives = sorted(((s, r) for s, r in scored if r[1] != a[1]), key=lambda x: key(*x))
        for p, r in positives:
            found = [(s, n) for s, n in negatives if 30 * p <= 100 * s <= 90 * p][:10]
            out |= {(a[0], r[0], k, n[0], p, s) for k, (s, n) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("leaf", [2, 64])
def test_negatives_of_odd_vectors(spark, monkeypatch, leaf):
    for name, value in (("LEAF", leaf), ("TREE_ROWS", 150), ("GATHERED", 1), ("BLOCK", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-3, 6)) / 256 for _ in range(4)], rng.randint(0, 2)) for i in range(0, 900, 3)]
    rows += [(i, [0.02, 0.02, 0.02, 0.02], rng.randint(0, 2)) for i in range(1, 400, 5)]  # one vector many times: ties by id
    rows += [(2000 + i, [0.5] * 3, i % 2) for i in range(6)]  # another length
    rows += [(2100, [float("nan"), 1.0], 1), (2200, [float("inf"), 1.0], 1), (2300, None, 1), (2400, [1.0] * 4, None), (2500, [1.0, None], 1), (2600, [], 1), (None, [0.02, 0.02, 0.02, 0.02], 1)]
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit("x")).withColumn("tree", F.lit("y"))
    got = {tuple(r) for r in hard_negatives.mine(hard_negatives.vectors(df), F.pmod("id", F.lit(100)) == 0).collect()}
    clean, seen = [], set()
    for i, v, label in rows:
        if v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, tuple(int(np.floor(256 * x)) for x in v))
        if row not in seen:
            seen.add(row)
            clean.append(row)
    assert got == plain_negatives(clean) and got
    assert hard_negatives.mine(hard_negatives.vectors(df.limit(0)), F.lit(True)).count() == 0


def test_negatives_beyond_doubles(spark):
    """Sums between 2^53 and 2^63 are exact; beyond, scores are held at the ends of 64 bits."""
    rng = random.Random(7)
    rows = [(i, [float(rng.randint(-(2**21), 2**21)) for _ in range(3)], i % 3) for i in range(120)]
    vectors = lambda rows: hard_negatives.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    clean = [(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(int(256 * x) for x in v)) for i, v, label in rows]
    got = {tuple(r) for r in hard_negatives.mine(vectors(rows), F.col("id") == 0).collect()}
    assert got == plain_negatives(clean, 10**6) and max(r[4] for r in got) > 2**53
    huge = [(i, [1e30, -1e300, 3.0 * i], i % 2) for i in range(4)]
    assert {r.positive_score for r in hard_negatives.mine(vectors(huge), F.col("id") == 0, from_percent=100, to_percent=100).collect()} <= {2**63 - 1}


def test_negatives_equal_oracle(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    df = hard_negatives.query(spark, sf_dir)
    want = con.execute(hard_negatives.ORACLE)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=byte_bpe.split_pattern(), mergeable_ranks=byte_bpe.ranks_of(byte_bpe.RANKS), special_tokens={})


def test_bytes_of_odd_rows(spark, odd, none, documents, plain, library):
    for docs, rows in ((odd, [(r[0], r[1]) for r in ROWS]), (documents, plain)):
        encoded = byte_bpe.encode(docs)
        got = sorted(((r.doc_id, bytes(r.ids_bytes), bytes(r.decoded), r.text, r.n_unknown) for r in byte_bpe.decode(encoded).collect()), key=str)
        want = [(i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode(), t or "", 0) for i, t in rows]
        assert got == sorted(want, key=str)
    assert byte_bpe.decode(byte_bpe.encode(none)).count() == 0
    back = byte_bpe.decode(spark.createDataFrame([(1, [50, 10**6, -1, None]), (2, None)], "doc_id long, ids array<int>")).orderBy("doc_id").collect()
    assert [(r.n_unknown, len(r.decoded)) for r in back] == [(3, 1), (0, 0)]


def test_digests_of_the_query(spark, sf_dir, plain, library):
    got = sorted(tuple(r) for r in byte_bpe.query(spark, sf_dir).collect())
    want = []
    for i, t in plain:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_units_of_any_kind(library):
    """Unicode white space, contractions, marks, long runs without white space, and special tokens as plain text."""
    bpe = byte_bpe.of(byte_bpe.RANKS, byte_bpe.split_pattern())
    rng = random.Random(3)
    pieces = ["a", "b", "the", " ", "  ", "\n", "'", "'s", "'re", "9", "12", "é", "日本", "。", "\xa0", "　", "\x1c", "\x85", "!", "!!", "ing", "́", "😀", "ZZ", "\t", "​", " ", "<|endoftext|>"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["日本語、テキスト。" * 20000, "ab12" * 40000 + " tail", "a.b!'s" * 30000, "word " * 300000, "".join(rng.choices(pieces, k=300000))]
    for text in texts:
        ids = np.frombuffer(bpe.encode(text), "<u4")
        assert ids.tolist() == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_split_characters(library):
    text = "日本語 é 😀 x"
    ids = library.encode_ordinary(text)
    decoder = byte_bpe.Decoder()
    parts = [decoder.feed([i]) for i in ids] + [decoder.feed([], True)]
    assert "".join(parts) == text and "" in parts
    bpe = decoder.bpe
    start, end = bpe.spans(text.encode(), np.array(ids))
    for k, i in enumerate(ids):  # a token's bytes lie in the bytes of the characters it spans
        assert bpe.decode(np.array([i])) in text[start[k] : end[k]].encode()
    assert start[0] == 0 and end[-1] == len(text) and (np.diff(start) >= 0).all()
    assert bpe.decode(np.array(ids[:1])).decode("utf-8", "replace") != text[:1] or len(ids) < len(text)


def test_ranks_of_another_file(spark, tmp_path):
    """A vocabulary of single bytes and two pairs, by path."""
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"abc"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(k).encode() for k, t in enumerate(tokens)))
    df = spark.createDataFrame([(1, "abc abcab")], "doc_id long, text string")
    row = byte_bpe.encode(df, str(path)).first()
    assert row.ids == [257, 32, 257, 256] and row.char_start == [0, 3, 4, 7] and row.char_end == [3, 4, 7, 9]
