"""Derivatives against a plain parser, and the files' round trip."""
import base64
import hashlib
import json
from html.parser import HTMLParser

from bidscope.llm import warc as W
from bidscope.llm.markup import BLOCKS, RAW
from bidscope.llm.queries import QUERIES


class Plain(HTMLParser):
    """Visible text and links, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.text, self.hidden, self.links = [], "", 0, []

    def end_line(self):
        if self.text.split():
            self.lines.append(" ".join(self.text.split()))
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag in RAW and tag != "head":
            self.hidden += 1
        if tag in BLOCKS or tag == "br":
            self.end_line()
        if tag == "a":
            self.links.append(dict(attrs).get("href"))

    def handle_endtag(self, tag):
        if tag in RAW and tag != "head":
            self.hidden -= 1
        if tag in BLOCKS:
            self.end_line()

    def handle_data(self, data):
        if not self.hidden:
            self.text += data


def sha1(raw):
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def test_query_against_a_plain_parser(spark):
    d = "/root/testdata/sf0.001"
    pages = {r.page_id: r for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    rows = QUERIES["op3_derivatives"](spark, d).collect()
    assert len(rows) == 2 * len(pages) and len({r.record_id for r in rows}) == len(rows)
    ids = {}
    for r in rows:
        page, raw = pages[r.page_id], r.block.encode()
        p = Plain()
        p.feed(page.html)
        p.close()
        p.end_line()
        assert (r.content_length, r.block_digest, r.source_digest) == (len(raw), sha1(raw), sha1(page.html.encode()))
        assert r.target_uri == page.url and ids.setdefault(r.page_id, r.refers_to) == r.refers_to
        if r.record_type == "conversion":
            assert r.block.split("\n") == p.lines
        else:
            seen = json.loads(r.block)
            links = [x["url"] for x in seen["html"]["links"] if x["path"] == "A@/href"]
            assert [x.rsplit("/", 1)[1] for x in links] == [x.rsplit("/", 1)[1] for x in p.links]
            assert seen["source"]["WARC-Record-ID"] == f"<{r.refers_to}>" and seen["source"]["WARC-Payload-Digest"] == r.source_digest
            assert seen["http-headers"]["Content-Length"] == str(len(page.html.encode()))


def test_edges_and_round_trip(spark, tmp_path):
    rows = [(1, "http://a.org/x/", '<a href="../é">l</a><p>one&lt;<br>two\r\n\r\nthree'), (2, None, None), (3, "http://[bad", '<a href="//["> z'),
            (4, "http://b.org", ""), (4, "http://b.org", ""), (None, "u", "<p>" + "w " * 60000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as block", "1 as payload", "2 as record_id")
    out = W.derive(W.responses(df, "2024-01-01T00:00:00Z"))
    got = out.collect()
    assert len(got) == 12
    text = {r.page_id: r.block for r in got if r.record_type == "conversion"}
    assert text[1] == "l\none<\ntwo three" and text[2] == "" and text[3] == "z" and text[4] == ""
    one = next(json.loads(r.block) for r in got if r.page_id == 1 and r.record_type == "metadata")
    assert one["html"]["links"] == [{"path": "A@/href", "url": "http://a.org/é"}]
    W.write_warc(out, str(tmp_path / "warc"), per_file=3)
    back = W.read_warc(spark, str(tmp_path / "warc")).collect()
    key = lambda kind, refers, block: (kind, refers, bytes(block))
    assert sorted(key(r.headers["WARC-Type"], r.headers["WARC-Refers-To"], r.block) for r in back) == sorted(
        key(r.record_type, f"<{r.refers_to}>", r.block.encode()) for r in got)
    assert all(sha1(bytes(r.block)) == r.headers["WARC-Block-Digest"] for r in back)
    assert W.derive(W.responses(df.limit(0), "d")).count() == 0
