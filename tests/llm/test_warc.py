"""Records read back from their bytes, links between them, and the text of pages."""

import hashlib
import time
from base64 import b32encode

from rimline.llm.common import table
from rimline.llm.warc import archived, derivatives, derive, digest, op7_warc_derivatives, parsed, plain_text, responses

SF_DIR = "/root/testdata/sf0.001"


def test_round_trip_and_links(spark):
    pages = {r.page_id: r for r in table(spark, SF_DIR, "pages").collect()}
    sources = {r.page_id: r for r in responses(table(spark, SF_DIR, "pages")).collect()}
    records = op7_warc_derivatives(spark, SF_DIR)
    found = records.collect()
    assert len(found) == 2 * len(pages)
    assert len({r.record_id for r in found}) == len(found)
    for r in found:
        source = sources[r.page_id]
        assert r.refers_to == source.record_id and r.target_uri == pages[r.page_id].url and r.source_headers == source.http_headers
        assert r.refers_to_payload_digest == "sha1:" + b32encode(hashlib.sha1(pages[r.page_id].html.encode()).digest()).decode()
        assert r.content_length == len(r.block.encode()) and r.block_digest == digest(r.block.encode())
    by_id = {r.record_id: r for r in found}
    for r in archived(records).collect():
        headers, block = parsed(bytes(r.record))
        own = by_id[headers["WARC-Record-ID"]]
        assert block == own.block.encode()
        assert headers["WARC-Refers-To"] == own.refers_to and headers["WARC-Block-Digest"] == digest(block)
        if own.warc_type == "metadata":
            fields = [line.split(": ", 1) for line in block.decode().split("\r\n") if line]
            said = dict(fields)
            assert said["source-record-id"] == own.refers_to
            assert by_id[said["conversion-record-id"]].warc_type == "conversion"
            assert said["conversion-digest"] == by_id[said["conversion-record-id"]].block_digest


def test_plain_text():
    page = '<html><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head><body><p>one <b>two</b><br>three<!-- no --><p>x &lt;y&gt;&nbsp; z</p></body></html>'
    assert plain_text(page) == "A & B\none two\nthree\nx <y> z"
    assert plain_text("") == "" and plain_text("<p") == "" and plain_text("a < b") == "a < b"
    assert plain_text("x<script>never ends") == "x" and plain_text("x<!-- never ends") == "x"
    assert plain_text("<p>" * 50_000 + "end") == "end"


def test_odd_rows(spark):
    rows = [(1, None, None, "x"), (None, "http://a/", "<p>t", "y"), (2, "u", "", "z"), (3, "line\nbreak", "<a href='x y'>l</a>" * 5000, "w"), (3, "line\nbreak", "<a href='x y'>l</a>" * 5000, "w")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    found = derivatives(responses(pages)).collect()
    assert len(found) == 10
    assert {r.block for r in found if r.warc_type == "conversion"} == {"", "t", "l" * 5000}
    assert derivatives(responses(pages.limit(0))).count() == 0


def test_tags_that_never_end(spark):
    """A megabyte of each, in time that grows with its length."""
    for piece in ("<a ", "<html ", "<title ", "<a href='", '<a href="x ', "<script ", "<!-- ", "</script ", "<a href= ", "<html lang ", "href  "):
        page = piece * (1_000_000 // len(piece))
        started = time.perf_counter()
        assert len(list(derive(1, "<urn:uuid:1>", "u", "d", "h", page))) == 2
        assert time.perf_counter() - started < 2, piece


def test_links_and_language():
    page = "<HTML class=x lang='de-AT'><a class=b href=one>1</a><A HREF = 'two x'>2</A><a name=n>3</a><a href=\"three\" <a href=four>"
    block = next(derive(1, "<urn:uuid:1>", "u", "d", "h", page))[-1]
    fields = [line.split(": ", 1) for line in block.split("\r\n") if line]
    assert [v for k, v in fields if k == "outlink"] == ["one", "two x", "three", "four"]
    assert dict(fields)["language"] == "de-AT"
