"""Shared ids in byte dedup, licence matches against a plain matcher, WARC pages against a plain parser and hostile pages."""

import gzip
import hashlib
import random
import time
from html.parser import HTMLParser

import numpy as np
import pytest

from stockyard.llm import license_scan, suffix_dedup, warc


def removed(spark, docs, partitions=3):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions)
    out = [(r.doc_id, r.n_bytes, r.n_removed, len(r.span_starts), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.dedup(df).collect()]
    return sorted(out, key=str)


def plain_removal(docs):
    low = [(-(2**63) if i is None else i, (t or "").encode()) for i, t in docs]
    back = lambda r: (None if r[0] == -(2**63) else r[0], *r[1:])
    return sorted(map(back, suffix_dedup.brute_force(low)), key=str)


@pytest.fixture()
def tiny_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_different_texts_under_one_id_take_nothing_from_each_other(spark, tiny_batches):
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    x, y = letters(300), letters(300)
    docs = [(1, x), (2, y), (2, letters(50) + x)]
    got = removed(spark, docs)
    assert got == plain_removal(docs) and sum(r[2] for r in got) == 300 and next(r for r in got if r[:2] == (2, 300))[2] == 0
    docs = [(None, x), (None, x + y), (None, letters(20) + x), (3, y[:200]), (3, x), (3, x)]
    assert removed(spark, docs) == plain_removal(docs)
    base = [letters(rng.choice([5, 60, 150, 400])) for _ in range(8)]
    for seed in range(3):
        rng.seed(seed)
        docs = [(rng.choice([None, 1, 2, 3, 4]), "".join(rng.choice(base) for _ in range(rng.randint(0, 4)))) for _ in range(40)]
        assert removed(spark, docs, 4) == plain_removal(docs), seed


def plain_matches(scan, tokens):
    """Every diagonal of text and template, and its runs of equal words that nothing extends."""
    out = set()
    for t, template in enumerate(scan.tokens):
        for d in range(-len(template), len(tokens)):
            run = 0
            for k in range(len(template) + 1):
                if k < len(template) and 0 <= d + k < len(tokens) and tokens[d + k] == template[k]:
                    run += 1
                else:
                    if run >= license_scan.MIN_MATCH:
                        out.add((t, d + k - run, k - run, run))
                    run = 0
    return out


def test_matches_equal_a_plain_matcher():
    rng = random.Random(2)
    made = [(f"l{k}", " ".join(rng.choices("p q r s t u", k=rng.randint(4, 14)))) for k in range(7)]
    for templates in (made, [("a", "x1 y1 z1 p q r s t"), ("b", "p q r s t u v w")], license_scan.TEMPLATES):
        scan = license_scan.Scanner(templates, {"p q": "pq"})
        words = sorted({w for s in scan.tokens for w in s})
        for _ in range(30):
            tokens = [w for _ in range(rng.randint(1, 5)) for s in [rng.choice(scan.tokens)] for at in [rng.randrange(len(s))] for w in s[at : at + rng.randint(1, 9)]]
            tokens += rng.choices(words, k=3)
            found = scan.spans(np.array(tokens), 0)
            assert len(found) == len(set(found)) and set(found) == plain_matches(scan, tokens)
    scan = license_scan.Scanner([("a", "x1 y1 z1 p q r s t"), ("b", "p q r s t u v w")], {})
    number = {w: k for k, w in enumerate(sorted(set("x1 y1 z1 p q r s t u v w".split())))}
    chains = scan.chained(scan.spans(np.array([number[w] for w in "x1 y1 z1 p q r s t".split()]), 0))
    assert chains[0][0] == 8 and chains[1][0] == 5


class Plain(HTMLParser):
    """Text of well-formed pages, title and links."""

    def __init__(self):
        super().__init__()
        self.out, self.hidden, self.title, self.in_title, self.links = [], 0, None, False, 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "noscript", "template", "svg")
        self.links += tag == "a" and any(k == "href" for k, _ in attrs)
        self.in_title = tag == "title" and self.title is None
        self.out.append("\n" if tag in warc.BLOCKS else " ")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "noscript", "template", "svg")
        self.in_title = False
        self.out.append("\n" if tag in warc.BLOCKS else " ")

    def handle_data(self, data):
        if self.in_title:
            self.title = (self.title or "") + data
        if not self.hidden:
            self.out.append(data)

    def text(self):
        lines = (" ".join(line.split()) for line in "".join(self.out).split("\n"))
        return "\n".join(line for line in lines if line)


def test_pages_equal_a_plain_parser(spark, sf_dir):
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        plain = Plain()
        plain.feed(row.html or "")
        plain.close()
        lines = ["".join(" ".join(line.split())) for line in warc.plain_text(row.html or "").split("\n")]
        assert "\n".join(lines) == plain.text()
        assert warc.title_of(row.html or "") == " ".join((plain.title or "").split())
        assert warc.links_of(row.html or "") == plain.links


@pytest.mark.parametrize("piece", ["<a ", "<p ", "<title>", "<title ", "</title ", "<a href", "<!--", "<script>", "</script ", "&#9999999999;", "<", "href = ", "charset = "])
def test_hostile_pages_take_seconds(piece):
    page = piece * (2_000_000 // len(piece))
    began = time.process_time()
    warc.derivatives(warc.response(1, "u", page))
    assert time.process_time() - began < 20


def test_headers_and_limits(monkeypatch):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\n\r\n<p>x"
    head = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-IP-Address", "192.0.2.1"), ("WARC-Concurrent-To", "<urn:y>"), ("WARC-Concurrent-To", "<urn:z>")]
    meta = warc.derivatives(warc.record(head, block))[0]["block"].decode()
    assert "source-warc-ip-address: 192.0.2.1\r\n" in meta and "source-warc-concurrent-to: <urn:y>\r\nsource-warc-concurrent-to: <urn:z>\r\n" in meta
    assert "http-set-cookie: a=1\r\nhttp-set-cookie: b=2\r\n" in meta
    with pytest.raises(ValueError, match="negative"):
        warc.parse(b"WARC/1.1\r\nContent-Length: -5\r\n\r\nabcdefgh\r\n\r\n")
    whole = warc.record(head, block)
    assert warc.parse(gzip.compress(whole)) == warc.parse(whole) == warc.parse(gzip.compress(whole[:50]) + gzip.compress(whole[50:]))
    monkeypatch.setattr(warc, "MOST_BYTES", 100)
    with pytest.raises(ValueError, match="unpacked"):
        warc.parse(gzip.compress(whole))
    assert warc.plain_text("a &#99999999999999999999; &#xFFFFFFFFF; &#65;") == "a � � A"
