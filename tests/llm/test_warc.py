import gzip
import hashlib
import re
from pathlib import Path

from tidemark.llm import warc
from tidemark.session import workspace

PAGES = [
    (1, "http://a.test/x", "<html lang='en'><head><title>A &amp; B</title><script>var x='</p>';</script></head><body><!-- no --><p>One<br>two &lt;3</p><a href='/l'>l</a></body></html>"),
    (2, None, None), (3, "", ""), (4, "http://b.test/\r\nX: y", "plain < text > 2"), (5, "http://c.test", "<p>" + "long \n text " * 30_000),
    (1, "http://a.test/x", "<html lang='en'><head><title>again</title></head></html>"), (None, "http://n.test", "<P>é ü</P>"),
]


def derived(spark):
    return warc.derive(warc.responses(spark.createDataFrame([(*p, "r", "t") for p in PAGES], "page_id long, url string, html string, record_id string, text string")))


def test_records_are_linked(spark):
    rows = derived(spark).collect()
    assert len(rows) == 2 * len(PAGES)
    for row in rows:
        block = row.block.encode()
        assert row.content_length == len(block) and row.block_digest == "sha256:" + hashlib.sha256(block).hexdigest()
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", row.record_id)
        partner = [r for r in rows if r.refers_to == row.refers_to and r.warc_type != row.warc_type]
        assert partner and all(r.target_uri == row.target_uri and r.source_payload_digest == row.source_payload_digest for r in partner)
        if row.warc_type == "metadata":
            assert row.concurrent_to in {r.record_id for r in partner}
            assert f"source-payload-digest: {row.source_payload_digest}\r\n" in row.block
    payloads = {"sha256:" + hashlib.sha256((p[2] or "").encode()).hexdigest() for p in PAGES}
    assert {r.source_payload_digest for r in rows} == payloads
    # The null page and the empty one are the same response.
    assert len({r.record_id for r in rows}) == len(rows) - 2


def test_plain_text(spark):
    texts = {r.key: r.block for r in derived(spark).filter("warc_type = 'conversion' AND target_uri <> '' AND (key <> 1 OR key IS NULL)").collect()}
    assert texts[4] == "plain < text > 2" and texts[None] == "é ü"
    first = derived(spark).filter("warc_type = 'conversion' AND key = 1").collect()
    assert "A & B\nOne\ntwo <3\nl" in {r.block for r in first}


def test_files_can_be_read_back(spark):
    records = derived(spark)
    folder = workspace(spark, "warc")
    warc.write(records, folder)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(folder.removeprefix("file://")).glob("part-*")))
    found, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        block = data[end + 4:end + 4 + size]
        assert data[end + 4 + size:end + 8 + size] == b"\r\n\r\n"
        assert headers["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        found.append((headers["WARC-Record-ID"], headers["WARC-Refers-To"], headers["WARC-Type"], headers["WARC-Refers-To-Payload-Digest"]))
        at = end + 8 + size
    expected = [(r.record_id, r.refers_to, r.warc_type, r.source_payload_digest) for r in records.collect()]
    assert sorted(found) == sorted(expected)


def test_empty_table(spark):
    assert warc.derive(warc.responses(spark.createDataFrame([], "page_id long, url string, html string"))).collect() == []


def test_all_character_references(spark):
    expected = {
        "caf&eacute;": "café", "a&hellip;b &ndash; &apos;": "a…b – '", "&#8217;&#x27;&#X2019;": "’'’", "a&#160;b&nbsp;c&#xA0;d": "a b c d",
        "&amp;lt; &amp;#39; &#38;amp;": "&lt; &#39; &amp;", "&copy 1 &copycat; &notin; &notit;": "&copy 1 &copycat; ∉ &notit;",
        "&nosuch; & &; &#; &#x; &#xZ;": "&nosuch; & &; &#; &#x; &#xZ;",
        "&#0;&#xD800;&#x110000;&#128;&#1;&#x1F600;": "���€\x01😀", "&#" + "9" * 5000 + ";&#000065;": "�A",
        "&lt;p&gt; &NotEqualTilde; &CounterClockwiseContourIntegral;": "<p> ≂̸ ∳", "a&NewLine;b&Tab;c": "a\nb c",
    }
    pages = spark.createDataFrame([(i, "http://e.test", f"<p>{html}</p>") for i, html in enumerate(expected)], "page_id long, url string, html string")
    records = warc.derive(warc.responses(pages)).filter("warc_type = 'conversion'").orderBy("key").collect()
    assert [r.block for r in records] == list(expected.values())
    assert all(r.content_length == len(r.block.encode()) for r in records)
