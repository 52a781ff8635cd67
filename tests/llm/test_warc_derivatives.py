from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import json
from html.parser import HTMLParser

import pytest

from feedlens.llm import warc_derivatives as wd

PAGE = (
    "<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<!-- no > text --><h1>Head</h1><p>One <b>bold</b>&nbsp;word<br>two<p>three &lt;x&gt; <a href='/rel?a=1&amp;b=2'>l</a>"
    "<a HREF=\"http://o.example/\">o</a> 2 < 3 <ul><li>i</ul></body></html>"
)
ROWS = [
    (1, "http://h.example/d/p", PAGE), (2, None, "<p>x"), (3, "u", None), (4, "", ""), (None, "http://[bad", "<a href='x'>a"),
    (1, "http://h.example/d/p", PAGE), (5, "u", "<script>never closed <p>a"), (6, "u", "<!-- never closed <p>a"),
    (7, "u", "<" * 20_000 + "end"), (8, "u", "ä\r\nö 日本 " * 3000),
]


@pytest.fixture(scope="module")
def derived(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("block", F.lit(1))
    return wd.derive(wd.responses(pages.withColumn("record_id", F.lit(None).cast("string"))))


def _sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_are_linked(derived):
    rows = derived.collect()
    assert len(rows) == 2 * len(ROWS)
    pairs = {}
    for r in rows:
        assert r["block_digest"] == _sha(r["block"].encode())
        pairs.setdefault(r["refers_to"], {})[r["record_type"]] = r
    for source, pair in pairs.items():
        assert set(pair) == {"metadata", "conversion"}
        about = json.loads(pair["metadata"]["block"])
        assert about["source"]["WARC-Record-ID"] == f"<{source}>"
        assert about["conversion"] == f"<{pair['conversion']['record_id']}>"
        assert f"WARC-Concurrent-To: {about['conversion']}" in pair["metadata"]["headers"]
        assert about["source"]["WARC-Payload-Digest"] == pair["conversion"]["payload_digest"]
    payloads = {_sha((html or "").encode()) for _, _, html in ROWS}
    assert {r["payload_digest"] for r in rows} == payloads


def test_content_of_a_page(derived):
    rows = {r["record_type"]: r["block"] for r in derived.where("page_id = 1").collect()}
    about = json.loads(rows["metadata"])
    assert about["html"] == {"title": "A & B", "links": ["http://h.example/rel?a=1&b=2", "http://o.example/"]}
    assert about["http"]["status"] == "HTTP/1.1 200 OK"
    assert about["http"]["headers"][0] == ["Content-Type", "text/html; charset=utf-8"]
    assert rows["conversion"] == "Head\nOne bold word\ntwo\nthree <x> lo 2 < 3\ni"


class _Words(HTMLParser):
    def __init__(self):
        super().__init__()
        self.silent, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.silent += tag in wd.SILENT
        if tag in wd.BLOCKS:
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.silent -= tag in wd.SILENT
        if tag in wd.BLOCKS:
            self.out.append(" ")

    def handle_data(self, data):
        if not self.silent:
            self.out.append(data)


def test_text_equals_that_of_another_parser(spark):
    import os

    path = "/root/testdata/sf0.001/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("test tables not present")
    for row in spark.read.parquet(path).select("html").limit(300).collect():
        parser = _Words()
        parser.feed(row["html"])
        parser.close()
        assert wd.page_content(row["html"], "http://x/")[1].split() == "".join(parser.out).split()


def test_files_read_back(derived, tmp_path):
    path = str(tmp_path / "out")
    wd.write_warc(derived, path)
    found = []
    for name in glob.glob(path + "/*.gz"):
        data = gzip.open(name).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == wd.VERSION
            fields = dict(line.split(": ", 1) for line in lines[1:])
            n = int(fields["Content-Length"])
            assert rest[n:n + 4] == b"\r\n\r\n" and fields["WARC-Block-Digest"] == _sha(rest[:n])
            found.append((fields["WARC-Record-ID"], fields["WARC-Refers-To"], rest[:n].decode()))
            data = rest[n + 4:]
    want = [(f"<{r['record_id']}>", f"<{r['refers_to']}>", r["block"]) for r in derived.collect()]
    assert sorted(found) == sorted(want)


def test_foreign_responses(spark):
    block = b"HTTP/1.1 404 Not Found\r\ncontent-type: text/html; charset=latin-1\r\nX: y: z\r\n\r\n<p>\xe9t\xe9"
    rows = [(1, "urn:uuid:1", "http://h/", "2020-01-01T00:00:00Z", bytearray(block), "sha1:B", "sha1:P"),
            (2, "urn:uuid:2", None, None, bytearray(b"no head"), None, None), (3, "urn:uuid:3", None, None, None, None, None)]
    got = wd.derive(spark.createDataFrame(rows, wd.RESPONSE.format(kind="long"))).collect()
    text = {r["page_id"]: r["block"] for r in got if r["record_type"] == "conversion"}
    assert text == {1: "été", 2: "no head", 3: ""}
    about = json.loads(next(r["block"] for r in got if r["page_id"] == 1 and r["record_type"] == "metadata"))
    assert about["source"]["WARC-Block-Digest"] == "sha1:B" and about["http"]["headers"][1] == ["X", "y: z"]


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert wd.derive(wd.responses(pages)).collect() == []


def test_quoted_signs_within_tags():
    for page, text, links in [
        ('<a title="a>b" href="/x">t</a>', "t", ["http://h/x"]),
        ("<a href='/y' title='<b>'>t</a> u", "t u", ["http://h/y"]),
        ('<p data-x = "1 > 2">one</p><p class=it\'s>two</p> three\'s', "one\ntwo\nthree's", []),
        ('<a href="/z>open</a> rest', "open rest", []),
        ('<img alt="never closed> a <b>c</b>', "a c", []),
    ]:
        assert wd.page_content(page, "http://h/")[1:] == (text, links), page
