import gzip
import hashlib
import random

import pytest

from textloom.llm import warc
from textloom.llm.common import scratch
from textloom.llm.store import open_store

KEYS = {
    "http://www.A.example/B?c=D#e": "example,a,www)/B?c=D",
    "https://a.example:443": "example,a)/",
    "https://a.example:8443/x": "example,a:8443)/x",
    "http://u:p@a.example/?q": "example,a)/?q",
    "http://10.0.0.1/x": "10.0.0.1)/x",
    "http://[::1]:80/x": "[::1])/x",
    "//a.example/x": "example,a)/x",
    "mailto:x y": "mailto:x%20y",
    "": "%",
    None: "-",
}


@pytest.mark.parametrize("url", list(KEYS))
def test_keys(url):
    assert warc.url_key(url) == KEYS[url]


def pages(seed=2, n=120):
    rng = random.Random(seed)
    bodies = ["<p>" + "é" * rng.randrange(30, 90) + str(i) for i in range(20)] + ["", "short", "x" * 99, "x" * 100]
    rows = [(i, f"http://h{rng.randrange(6)}.example/{rng.randrange(9)}?é={rng.randrange(3)}", rng.choice(bodies)) for i in range(n)]
    return [*rows, (500, None, None), (501, "a b\r\nc", "y" * 200), (None, "http://n.example/", "y" * 200), (None, "http://n.example/", "z" * 200), (3, rows[3][1], rows[3][2])]


def expected(rows):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(page, first.get(body, page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        repeat = body in first and first[body] != page
        out.append((-1 if page is None else page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if repeat else "response", first[body] if repeat else None))
    return sorted(out, key=str)


def test_round_trip_and_lookup(spark, make, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 7)
    rows = pages()
    table = make([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    folder = scratch(spark, "test-warc")
    captures = warc.write_archives(warc.with_decisions(table), f"{folder}/archive")
    archive = warc.Archive(spark, folder, warc.write_index(captures, f"{folder}/index", lines=7))
    got = archive.lookup(table).collect()
    assert sorted([(-1 if r.page_id is None else r.page_id, *r[2:6]) for r in got], key=str) == expected(rows)
    bodies = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in rows}
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or bytes(r.payload) == bodies[r.payload_digest]
    # Single URLs: all captures of the same key, however often it is asked for, and none of others.
    for url in {rows[0][1], rows[1][1], "http://h1.example/none", None}:
        asked = make([(url,), (url,)], "url string")
        found = archive.lookup(asked, with_payload=False).collect()
        assert sorted(str(r.page_id) for r in found) == sorted(str(p) for p, u, _ in rows if warc.url_key(u) == warc.url_key(url))


def test_files_follow_the_standard(spark, make):
    folder = scratch(spark, "test-warc")
    table = make([(1, "http://a.example/", "x" * 150), (2, "http://b.example/", "x" * 150)], "page_id long, url string, html string", 1)
    captures = warc.write_archives(warc.with_decisions(table), folder).collect()
    fs, path = open_store(folder)
    data = fs.open_input_stream(f"{path}/{captures[0].file}", compression=None).read()
    text = gzip.decompress(data).decode()
    assert text.count("WARC/1.1\r\n") == 2 and text.endswith("\r\n\r\n")
    ids = [line.split(": ")[1] for line in text.split("\r\n") if line.startswith("WARC-Record-ID")]
    refers = [line.split(": ")[1] for line in text.split("\r\n") if line.startswith("WARC-Refers-To:")]
    assert len(set(ids)) == 2 and refers[0] in ids
    assert f"WARC-Payload-Digest: sha256:{hashlib.sha256(b'x' * 150).hexdigest()}" in text
    for c in captures:
        assert gzip.decompress(data[c.offset : c.offset + c.length]).startswith(b"WARC/1.1\r\n")


def test_frequent_url_goes_over_blocks(spark, make):
    rows = [(i, "http://hot.example/", f"body {i}" * 20) for i in range(100)] + [(1000, "http://cold.example/", "c")]
    table = make(rows, "page_id long, url string, html string")
    folder = scratch(spark, "test-warc")
    parts = warc.write_index(warc.write_archives(warc.with_decisions(table), f"{folder}/archive"), f"{folder}/index", lines=5)
    archive = warc.Archive(spark, folder, parts)
    located = warc.locate(make([("http://hot.example",)], "url string"), f"{folder}/index", parts)
    assert located.count() >= 20
    assert archive.lookup(make([("HTTP://HOT.example",)], "url string")).count() == 100


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(none).lookup(none).collect() == []
