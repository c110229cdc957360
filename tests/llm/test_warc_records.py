"""Text, links, header values and files of the WARC derivatives against independent versions."""
import gzip
import random
import re
import time
from collections import Counter
from html.parser import HTMLParser

from twinlens.llm import warc_derivatives as wd


def plain_by_regex(page):
    """One expression after the other over the whole page, in quadratic time for unclosed tags."""
    text = re.sub(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", " ", page)
    return wd._LINES.sub("\n", wd._SPACE.sub(" ", wd.html.unescape(wd._TAG.sub("", wd._BREAK.sub("\n", text))))).strip()


def test_text_equals_the_plain_version():
    rng = random.Random(4)
    bits = ["<p>", "</p>", "<a href='x'>", "<a ", "<", ">", "<!--", "-->", "<script>", "</script >", "<style", "x", " ", "\n",
            "&amp;", "word", "<br/>", "</", "<title>", "é"]
    for _ in range(6000):
        page = "".join(rng.choice(bits) for _ in range(rng.randrange(25)))
        assert wd.plain_text(page) == plain_by_regex(page), page


class Reference(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.said, self.hidden = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        if tag in ("a", "link", "img", "script", "iframe", "form"):
            self.out += [(tag, v) for k, v in attrs if k in ("href", "src", "action")]

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.hidden:
            self.said += data.split()


def test_links_and_words_equal_a_parser(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect() if r.html]
    pages += ["<p>a &lt; b</p><img src='i.png'><a class=c href=/q?x=1&amp;y=2>go</a><form action=\"/f\"></form>"
              "<script src=s.js>var a = '<a href=no>';</script><!-- <a href=no> --><link rel=x href='c.css'>"]
    for page in pages:
        ref = Reference()
        ref.feed(page)
        ref.close()
        assert wd.links(page) == ref.out
        assert "".join(wd.plain_text(page).split()) == "".join(ref.said)


def test_unclosed_tags_take_linear_time():
    for bit in ("<a ", "<p ", "<script ", "<!-- ", "<a <script></script>", "<a href='", "<style>"):
        page = bit * (1_000_000 // len(bit))
        start = time.time()
        wd.plain_text(page)
        wd.links(page)
        wd.plain_text("<b>" + page + "<p>")
        assert time.time() - start < 20, bit


def test_files_come_back(spark, tmpdir_path):
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nWARC-Type: x", "<p>a</p>\r\n\r\nWARC/1.1\r\n\r\n", "c"), (2, None, None, None),
         (3, "http://c/", "y" * 3_000_000, ""), (3, "http://c/", "y" * 3_000_000, "")],
        "page_id long, url string, html string, block string").withColumnRenamed("block", "record_id")
    derived = wd.derive(wd.responses(pages))
    wd.write(derived.repartition(2), tmpdir_path + "/w")
    back = wd.read(spark, tmpdir_path + "/w/*.gz")
    same = ["record_type", "record_id", "refers_to", "date", "content_type", "block_digest", "source_block_digest",
            "source_payload_digest", "block"]
    rows = [Counter((*[r[c] for c in same[:-1]], bytes(r.block)) for r in df.select(same).collect()) for df in (derived, back)]
    assert rows[0] == rows[1] and sum(rows[0].values()) == 8
    uris = {r.uri for r in back.collect()}
    assert uris == {"http://a/%0D%0AWARC-Type: x", "", "http://c/"}


def test_members_and_cut_files():
    def record(block):
        return b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)

    blocks = [b"", b"\r\n\r\n" * 9, bytes(range(256)) * 9000, b"end"]
    plain = b"".join(map(record, blocks))
    zipped = b"".join(gzip.compress(record(b)) for b in blocks)
    for data in (plain, zipped, gzip.compress(plain)):
        for step in (1, 7, 1 << 20) if data is zipped else (997, 1 << 20):
            assert [b for _, b in wd.records(wd._inflated(data, step))] == blocks
    assert [b for _, b in wd.records(wd._inflated(plain[:-8]))] == blocks[:-1]
    assert [b for _, b in wd.records(wd._inflated(zipped[:-9]))][:3] == blocks[:3]
    assert list(wd.records(iter([b"no record\r\n\r\n"]))) == list(wd.records(iter([]))) == []
