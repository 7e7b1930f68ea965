"""The training-data operators on Spark: against brute force on the small tables, and on odd rows."""

import os
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stockyard.llm import bit_planes, decontaminate, license_scan, line_dedup, near_dup, packing, quality_ledger, registry, suffix_dedup, toxicity, warc
from tests.llm.conftest import ROWS


def encoded(text):
    enc = bit_planes.encoder(bit_planes.TOKENIZER)
    return [*enc.tokenizer.encode(text or "", add_special_tokens=False).ids, bit_planes.END_ID]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture()
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_each_operator_has_a_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14))


def test_ledger_equals_oracle(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = quality_ledger.query(spark, sf_dir)
    want = con.execute(quality_ledger.ORACLE)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())


def test_ledger_windows_and_ablations(spark, odd, none):
    rows = spark.createDataFrame([(1, "a b c a b c"), (2, "a a a a"), (3, "a b"), (4, "x\nx\n \n\nx"), (5, "a b c d a b c e")], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_ledger.measurements(rows).collect()}
    assert [got[k].n_repeat_words for k in range(1, 6)] == [6, 4, 0, 0, 6]
    assert got[4].n_dup_lines == 2 and got[4].n_lines == 3
    assert quality_ledger.ledger(odd).count() == len(ROWS) and quality_ledger.ledger(none).count() == 0
    entries = quality_ledger.ledger(odd)
    kept = quality_ledger.apply_policy(entries, quality_ledger.STANDARD).where("kept").count()
    for r in quality_ledger.ablations(entries, quality_ledger.STANDARD).collect():
        other = quality_ledger.Policy("o", 1, tuple(x for x in quality_ledger.STANDARD.rules if x != r.rule))
        assert r.n_kept_without == quality_ledger.apply_policy(entries, other).where("kept").count() == kept + r.n_only


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_token_files_round_trip(spark, odd, none, tmp_path, mode):
    bit_planes.write_ids(odd, str(tmp_path / "ids"), block=64, mode=mode)
    got = sorted((tuple(r) for r in bit_planes.read_documents(spark, str(tmp_path / "ids")).collect()), key=lambda r: r[1])
    start = 0
    for (doc_id, text), row in zip(sorted(((r[0], r[1]) for r in ROWS), key=lambda r: (r[0] is not None, r[0], r[1] or "")), got, strict=True):
        ids = encoded(text)
        assert row == (doc_id, start, len(ids), crc(ids))
        start += len(ids)
    blocks = bit_planes.read_tokens(spark, str(tmp_path / "ids")).orderBy("shard", "chunk").collect()
    assert sum(len(b.ids) for b in blocks) == start and max(len(b.ids) for b in blocks) == 64
    bit_planes.write_ids(none, str(tmp_path / "none"))
    assert bit_planes.read_documents(spark, str(tmp_path / "none")).count() == 0


def test_packing_holds_every_id_once(spark, odd, none, documents, small_batches):
    for docs, texts in ((odd, [(r[0], r[1]) for r in ROWS]), (documents, None)):
        texts = texts or [(r.doc_id, r.text) for r in documents.collect()]
        pieces = packing.pack(docs).collect()
        sequences, by_doc = defaultdict(list), defaultdict(list)
        for p in pieces:
            sequences[p.sequence_id].append(p)
            by_doc[p.doc_id].append(p)
        for seq in sequences.values():
            at = 0
            for p in sorted(seq, key=lambda p: p.offset):
                assert p.offset == at and p.length > 0
                at += p.length
            assert at <= packing.SIZE
        pad = sum(packing.padding(sum(p.length for p in seq)) for seq in sequences.values())
        total = sum(p.length for p in pieces)
        assert total == sum(len(encoded(t)) for _, t in texts)
        if docs is documents:
            assert pad <= 0.01 * total + 2048
        counts = defaultdict(int)
        for i, _ in texts:
            counts[i] += 1
        for doc_id, text in texts:
            if counts[doc_id] == 1:
                ids, at = encoded(text), 0
                for p in sorted(by_doc[doc_id], key=lambda p: p.start):
                    assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), crc(ids[at : at + p.length]))
                    at += p.length
                assert at == len(ids)
    assert packing.pack(none).count() == 0


def test_suffix_dedup_equals_brute_force(spark, documents, plain, odd, none, small_batches):
    rows = lambda df: sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.span_starts), r.kept) for r in df.collect())
    digest = lambda rs: [(a, b, c, d, __import__("hashlib").sha256(k).hexdigest()) for a, b, c, d, k in rs]
    assert digest(rows(suffix_dedup.dedup(documents))) == suffix_dedup.brute_force([(i, (t or "").encode()) for i, t in plain])
    rng = random.Random(9)
    base = [bytes(rng.choice(b"ab ") for _ in range(rng.choice([5, 50, 150, 400]))) for _ in range(12)]
    docs = [(k * 7 % 61, b"".join(rng.choice(base) for _ in range(rng.randint(0, 4))) + b"z" * rng.choice([0, 0, 300])) for k in range(60)]
    df = spark.createDataFrame([(i, t.decode()) for i, t in docs], "doc_id long, text string").repartition(5)
    assert digest(rows(suffix_dedup.dedup(df))) == suffix_dedup.brute_force(docs)
    got = {(r.doc_id, r.n_removed) for r in suffix_dedup.dedup(odd).collect()}
    size = len("same text twice " * 20)
    assert {n for i, n in got if i == 7} == {size} and {n for i, n in got if i == 6} == {size - 16}
    assert suffix_dedup.dedup(none).count() == 0


def test_near_duplicates_equal_brute_force(spark, plain, documents, odd, none):
    got = sorted(map(tuple, near_dup.near_duplicates(documents, words=2).collect()))
    assert got == near_dup.brute_force(plain, 2)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(near_dup.near_duplicates(odd, words=2).collect()) == order(near_dup.brute_force([r[:2] for r in ROWS], 2))
    assert near_dup.near_duplicates(none).count() == 0


@pytest.mark.parametrize("lone", [1, None])
def test_near_duplicates_with_shared_ids(spark, lone):
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    a, b = words("a", 60), words("b", 60)
    docs = [(lone, a), (lone, b), (5, a + " tail"), (7, b + " tail"), (9, b + " tail"), (9, b + " tail"), (lone, words("c", 60)), (11, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = near_dup.near_duplicates(df, words=2)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(out.collect()) == order(near_dup.brute_force(docs, 2))
    kept = out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    assert kept.where("kept IS NULL").count() == 0 and {r.doc_id for r in kept.where("kept").collect()} == {lone, 11}
    texts = sorted(r.text for r in near_dup.leaders(df, words=2).collect())
    assert texts == sorted([a, b, words("c", 60), ""])


def test_near_duplicate_families(spark, monkeypatch):
    """Centres, their variants, copies of variants and cut copies, all in few groups: with small parts forced."""
    monkeypatch.setattr(near_dup, "GROUP", 16)
    monkeypatch.setattr(near_dup, "LEAF", 16)
    monkeypatch.setattr(near_dup, "WIDE", 40)
    monkeypatch.setattr(near_dup, "FEW", 3)
    monkeypatch.setattr(near_dup, "FREQUENT", 6)
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    base = [word() for _ in range(120)]
    second = [w if k % 9 else word() for k, w in enumerate(base)]
    docs, seen = [], [base, second]
    for i in range(240):
        w = list(rng.choice(seen))
        for _ in range(rng.choice([0, 1, 3, 5, 8, 12])):
            w[rng.randrange(len(w))] = word()
        w = w[: rng.choice([120, 120, 120, 100, 90, 60])]
        if rng.random() < 0.3 and len(w) > 80:
            seen.append(w)
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = near_dup.brute_force(docs, 2)
    assert sorted(map(tuple, near_dup.near_duplicates(df, words=2).collect())) == want
    assert len({c for _, _, c in want}) > 5


def test_line_dedup_equals_brute_force(spark, plain, documents, odd, none):
    got = {r.doc_id: r.kept for r in line_dedup.line_dedup(documents).collect()}
    assert got == dict(line_dedup.brute_force(plain))
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(documents).collect()} == got
    rng = random.Random(2)
    lines = [" ".join(rng.choices("abcdefg", k=rng.choice([0, 1, 4, 9, 25]))) for _ in range(14)]
    docs = [(k, "\n".join(rng.choices(lines, k=rng.randint(0, 12)))) for k in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.kept for r in line_dedup.line_dedup(df).collect()} == dict(line_dedup.brute_force(docs))
    out = line_dedup.dedup_lines(odd)
    assert out.columns == odd.columns and out.count() == len(ROWS)
    kept = sorted(r.text for r in out.where("doc_id IN (6, 7)").collect())
    assert kept == ["", "same text twice " * 20, "same text twice " * 20]
    assert out.where("doc_id = 2").first().text is None
    assert line_dedup.dedup_lines(none).count() == 0


def test_licences(spark, plain, documents, odd, none):
    texts = dict(plain)
    for r in license_scan.scan(documents).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == license_scan.brute_base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    row = license_scan.scan(odd).where("doc_id = 8").first()
    assert (row.n_base, row.first_word, row.last_word, row.labels, row.score) == (3, 3, 7, "mit", 1.0)
    assert license_scan.scan(odd).count() == len(ROWS) and license_scan.scan(none).count() == 0


def test_line_dedup_holds_runs_against_all_earlier_places(spark):
    w, y = " ".join(f"w{k}" for k in range(24)), "a short line\n\nand another one"
    docs = [(1, f"{w}\nonly here"), *((k, f"x{k}\n{w}\n{y}\nz{k}") for k in range(2, 9))]
    got = {r.doc_id: r.kept for r in line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: docs[0][1], 2: f"x2\n{y}\nz2"} | {k: f"x{k}\nz{k}" for k in range(3, 9)}
    rng = random.Random(5)
    lines = ["", "  ", *(" ".join(f"v{k}" for _ in range(n)) for k, n in enumerate((1, 2, 3, 5, 6, 8)))]
    docs = [(k, "\n".join(rng.choices(lines, k=rng.randrange(12)))) for k in range(300)]
    got = {r.doc_id: r.kept for r in line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string"), 6).collect()}
    assert got == dict(line_dedup.brute_force(docs, 6))


def test_line_dedup_tells_rows_with_shared_ids_apart(spark):
    line = [" ".join(f"{c}{k}" for k in range(24)) for c in "abc"]
    docs = [(None, f"{line[0]}\n{line[1]}"), (None, f"{line[2]}\n{line[0]}"), (4, line[1]), (4, line[2] + "\nx"), (5, "y"), (5, "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit(1)).repartition(3)
    order = lambda rows: sorted(set(rows), key=str)
    want = order(line_dedup.brute_force(docs))
    assert order((r.doc_id, r.kept) for r in line_dedup.line_dedup(df).collect()) == want
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns and out.count() == len(docs) and order((r.doc_id, r.text) for r in out.collect()) == want
    assert sum(r.text.count(x) for r in out.collect() for x in line) == 3


def test_toxicity_is_learned(spark, sf_dir, odd, none):
    big = os.environ.get("TEST_TOXIC_DIR", "/root/testdata/sf0.01")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    out = toxicity.query(spark, big).join(labels, "doc_id")
    clean, caught, toxic = out.where("held_out AND toxic = 0").agg(F.avg("predicted")).first()[0], *out.where("held_out AND toxic = 1").agg(F.sum("predicted"), F.count("*")).first()
    assert clean <= 0.02 and caught >= 0.5 * toxic
    model = toxicity.fit(docs, labels)
    worst = toxicity.score(docs, model).where("score >= 0.9").first()
    text = docs.where(F.col("doc_id") == worst.doc_id).first().text.encode()
    assert worst.offending and all(0 <= s.start < s.end <= len(text) for s in worst.offending)
    got = {r.doc_id: r.score for r in toxicity.score(odd, model).collect()}
    assert got[2] == got[3] == got[4] == 0 and len(got) == len({r[0] for r in ROWS})
    assert toxicity.score(none, model).count() == 0
    unlabelled = toxicity.fit(docs, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert len(unlabelled.hashes) == 0 and toxicity.score(odd, unlabelled).count() == len(ROWS)


def test_decontamination(spark, sf_dir, plain, documents, odd, none):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bench = spark.createDataFrame([*items, (None, "x y"), (99999, None), (99998, "a b"), items[0]], "item_id long, text string")
    got = {r.doc_id: (r.item_ids, r.distance) for r in decontaminate.matches(documents, bench).collect()}
    texts = dict(plain)
    for i in [i for i, v in got.items() if v[0]] + [i for i in texts if len(texts[i] or "") < 600][:40]:
        assert got[i] == decontaminate.brute_force(texts[i], items), i
    assert all(got[i][0] for i, t in plain if any(x in (t or "") for _, x in items))
    assert decontaminate.matches(odd, bench).count() == len(ROWS) and decontaminate.matches(none, bench).count() == 0
    assert decontaminate.matches(odd, bench.limit(0)).where("size(item_ids) > 0").count() == 0


def test_decontamination_finds_short_items_scripts_without_spaces_and_items_without_id(spark, monkeypatch):
    zh = "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"
    items = [(1, "Who wrote it?"), (2, "forty-two"), (3, "Paris"), (4, "one two three four five"), (5, zh), (6, "กรุงเทพ"), (None, "a short one, without id"), (None, "another of none"), (7, " ?! "), (8, None), (9, "東京")]
    docs = [
        (1, "so who WROTE it, then"), (2, "forty one two"), (3, "in paris. Paris, paris"), (4, "x one two three four five"), (5, "one two three four six"), (6, "诗" + zh[:9] + "了" + zh[10:] + "。"), (7, zh[:6] + "x" + zh[6:9]),
        (8, "ที่กรุงเทพมหานคร"), (9, "here: a short one without id"), (10, "forty"), (11, "two"), (12, ""), (13, None), (14, "abc東京tower 大阪"), (15, "another of none; a short one without id"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {i: decontaminate.brute_force(t, items) for i, t in docs}
    found = {i for i, (ids, _) in want.items() if ids}
    assert found == {1, 3, 4, 6, 8, 9, 14, 15} and want[9] == ([None], 0) and want[6] == ([5], 1)
    for size in (20_000, 3):
        monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", size)
        assert {r.doc_id: (r.item_ids, r.distance) for r in decontaminate.matches(df, bench).collect()} == want
        assert {r.doc_id for r in decontaminate.clean_documents(df, bench).collect()} == {i for i, _ in docs} - found


def test_decontamination_finds_edits_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([8, 15, 16, 33, 60])))) for k in range(6)]
    docs = []
    for k in range(40):
        w = rng.choice(items)[1].upper().split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w)) : rng.randrange(len(w)) + 1] = rng.choices(vocabulary, k=rng.randint(0, 2))
        docs.append((k, ", ".join([*rng.choices(vocabulary, k=20), *w, *rng.choices(vocabulary, k=9)])))
    got = {r.doc_id: (r.item_ids, r.distance) for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {i: decontaminate.brute_force(t, items) for i, t in docs}


def test_warc_rows(spark, none):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x</p>"), (2, None, None), (None, "http://b/", ""), (1, "http://a/", "<p>x</p>")], "page_id long, url string, html string").withColumn("record", F.lit("clash"))
    rows = warc.derive(warc.responses(pages)).collect()
    assert len(rows) == 8 and {r.warc_type for r in rows} == {"metadata", "conversion"}
    assert {bytes(r.block) for r in rows if r.warc_type == "conversion" and r.page_id == 1} == {b"x"}
    bad = warc.derive(spark.createDataFrame([(1, bytearray(b"junk")), (2, None)], "page_id long, record binary")).collect()
    assert [r.warc_type for r in bad] == ["error", "error"] and all(r.error for r in bad)
    assert warc.members(warc.derive(warc.responses(pages))).count() == 8
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0
