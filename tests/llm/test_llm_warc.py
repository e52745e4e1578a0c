"""Derived records: links, headers, digests and plain text."""

import base64
import gzip
import hashlib
import random
import re
import time
import zlib

import pytest

from tillwise.llm import common, warc

PAGE = ("<!DOCTYPE html><html lang='en'><head><title>A &amp;\n B</title><style>p{}</style><script>var t='</p>';</script></head>"
        "<body><!-- x > y --><p>One <b>two</b>&nbsp;three<br>four</p><a href=\"/u?a=1&amp;b=2\">link</a><img src='i.png'>"
        "<script>unclosed</body>")


def block(body, kind="text/html; charset=utf-8"):
    return f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\nX-Other: a: b\r\n\r\n".encode() + body


def chunked(data, n=7):
    parts = [data[i:i + n] for i in range(0, len(data), n)]
    return b"".join(b"%x;a=b\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "record_id string, target_uri string, warc_date string, "
                               "warc_headers map<string,string>, block binary, warc_type string")
    return warc.derivatives(df).collect()


def one(spark, body, kind="text/html; charset=utf-8", headers=None):
    rows = run(spark, [("<urn:uuid:1>", "http://a/", "2024-01-01T00:00:00Z", headers or {}, block(body, kind))])
    return {r.warc_type: r for r in rows}


def test_records_are_linked_and_keep_their_source(spark):
    payload = PAGE.encode()
    claimed = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    got = one(spark, payload, headers={"WARC-Payload-Digest": claimed, "WARC-IP-Address": "10.0.0.1"})
    assert set(got) == {"metadata", "conversion"}
    for r in got.values():
        assert r.refers_to == "<urn:uuid:1>" and r.refers_to_target_uri == r.target_uri == "http://a/"
        assert r.refers_to_date == "2024-01-01T00:00:00Z" and r.source_payload_digest == claimed
        assert r.source_digests_hold is True and "WARC-IP-Address: 10.0.0.1\r\n" in r.source_headers
        assert "X-Other: a: b\r\n" in r.http_headers
        data = r.block.encode()
        assert r.content_length == len(data) and r.block_digest == warc.digest(data)
    assert got["metadata"].concurrent_to == got["conversion"].record_id != got["metadata"].record_id
    assert got["conversion"].concurrent_to == got["metadata"].record_id


def test_plain_text_and_metadata_fields(spark):
    got = one(spark, PAGE.encode())
    assert got["conversion"].block == "A & B\nOne two three\nfour\nlink"
    fields = got["metadata"].block.split("\r\n")
    assert "title: A & B" in fields and "language: en" in fields and "http-status: 200" in fields
    assert [f for f in fields if f.startswith("outlink")] == ["outlink: /u?a=1&b=2 a/@href", "outlink: i.png img/@src"]


@pytest.mark.parametrize("body, kind, text", [
    (b"", "text/html", ""), (b"plain\n<b>", "text/plain", "plain\n<b>"), ("é".encode("latin-1"), "text/plain; charset=iso-8859-1", "é"),
    (b"\xff\xfe", "text/plain; charset=nonsense", "��"), (b"<p>a" * 3, "text/html", "a\na\na"),
    (b"<" * 50_000, "text/html", "<" * 50_000), (b"&lt;p&gt; &#233;", "application/xhtml+xml", "<p> é")])
def test_texts(spark, body, kind, text):
    assert one(spark, body, kind)["conversion"].block == text


def test_odd_records(spark):
    rows = [("a", None, None, None, None), ("b", "u", "d", {}, b""), ("c", "u", "d", {}, b"not http at all"),
            (None, "u", "d", {}, block(b"x", "text/plain")), ("d", "u", "d", {"WARC-Payload-Digest": "sha1:WRONG"}, block(b"\x89PNG", "image/png")),
            ("b", "u", "d", {}, b"")]
    got = run(spark, rows)
    assert sorted((r.refers_to or "", r.warc_type) for r in got) == [
        ("", "conversion"), ("", "metadata"), ("a", "metadata"), ("b", "metadata"), ("b", "metadata"), ("c", "metadata"), ("d", "metadata")]
    assert all(r.record_id is None for r in got if r.refers_to is None)
    assert [r.source_digests_hold for r in got if r.refers_to == "d"] == [False]
    assert run(spark, []) == []


def test_whole_pages_table(spark):
    pages = common.table(common.prepare(spark), "/root/testdata/sf0.001", "pages")
    rows = warc.derivatives(warc.responses(pages)).collect()
    html = {r.url: r.html for r in pages.collect()}
    assert len(rows) == 2 * pages.count() and len({r.record_id for r in rows}) == len(rows)
    assert all(r.source_digests_hold for r in rows)
    assert all(r.source_payload_digest == "sha1:" + hashlib.sha1(html[r.target_uri].encode()).hexdigest() for r in rows)
    assert all("<" not in r.block.replace("<urn", "") or "&lt;" in html[r.target_uri] for r in rows if r.warc_type == "conversion")


def test_text_after_tags_without_an_end_stays():
    for page in ("a <svg width=1/> b", "a <svg/> b", "a <svg-icon></svg-icon> b", "a <template-card>x</template-card> b".replace("x", ""),
                 "a <style-guide> b", "a <svg><path/></svg> b", "a <SVG\nclass='x'><g>no</g></svg > b", "a <template>no</template> b",
                 "a <svg d='1'/> <svg>no</svg> b", "a <svg> b", "a <noscript>no</noscript><script>if (1 < 2) {}</script> b"):
        assert warc.plain_text(page).split() == ["a", "b"], page
    for page in ("a <script>no", "a <style >no", "a <!-- no", "a <script/src=x>no</script>"):
        assert warc.plain_text(page) == "a", page


def test_what_is_shown_is_what_plain_patterns_leave():
    """A pattern that looks for every closing tag anew, which takes the square of the page."""
    dropped = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>]).*?(?:</\1\s*>|\Z)|<svg(?:\s[^<>]*)?/>|"
                         r"<(noscript|template|svg)(?=[\s/>])[^<>]*>.*?</\2\s*>", re.I | re.S)
    title = re.compile(r"<title\b[^<>]*>(.*?)</title", re.I | re.S)
    rng = random.Random(5)
    parts = ["<svg>", "<svg/>", "<svg a='b'/>", "</svg>", "</SVG >", "<svg", "<svg-icon>", "<template x>", "</template>", "<noscript>",
             "</noscript>", "<script>", "</script\n>", "<style ", "</style>", "<!--", "-->", "<title>", "<title", "</title>", "word", ">", " "]
    for _ in range(4000):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert warc._shown(page) == dropped.sub(" ", page), page
        found = title.search(page)
        assert warc._title(page) == (found[1] if found else ""), page


@pytest.mark.parametrize("tag", ["<svg>", "<template a>", "<title>", "<svg", "<!-", "<noscript>x", "</svg", "<style>", "<svg a='"])
def test_tags_without_an_end_take_time_in_proportion(tag):
    def seconds(n):
        page, best = tag * n, None
        for _ in range(3):
            start = time.perf_counter()
            warc.plain_text(page)
            warc._title(page)
            best = min(best or 1e9, time.perf_counter() - start)
        return best

    # Eight times the page: the square would take 64 times as long.
    assert seconds(80_000) < 24 * max(seconds(10_000), 0.001)


RAW = zlib.compressobj(wbits=-15)
RAW = RAW.compress(PAGE.encode()) + RAW.flush()


@pytest.mark.parametrize("codings, body", [
    ("Content-Encoding: gzip", gzip.compress(PAGE.encode())),
    ("content-encoding: x-gzip", gzip.compress(PAGE[:30].encode()) + gzip.compress(PAGE[30:].encode()) + b"\0\0"),
    ("Content-Encoding: deflate", zlib.compress(PAGE.encode())), ("Content-Encoding: deflate", RAW),
    ("Transfer-Encoding: chunked", chunked(PAGE.encode())),
    ("Transfer-Encoding: chunked\r\nContent-Encoding: gzip", chunked(gzip.compress(PAGE.encode()))),
    ("Transfer-Encoding: gzip, chunked", chunked(gzip.compress(PAGE.encode()))),
    ("Content-Encoding: deflate, gzip", gzip.compress(zlib.compress(PAGE.encode()))),
    ("Transfer-Encoding: chunked\r\nContent-Encoding: gzip", PAGE.encode()), ("Content-Encoding: identity", PAGE.encode())])
def test_coded_payloads_are_decoded(codings, body):
    data = block(body).replace(b"X-Other", codings.encode() + b"\r\nX-Other")
    record = {"record_id": "r", "block": data, "target_uri": "u", "warc_date": "d", "warc_headers": [
        ("WARC-Payload-Digest", warc.digest(body))]}
    got = {r[1]: r for r in warc.derive(record)}
    assert got["conversion"][-1] == "A & B\nOne two three\nfour\nlink" and got["conversion"][13] is True
    assert "title: A & B" in got["metadata"][-1]


def test_broken_and_unknown_codings():
    def derived(codings, body, digest_of=None):
        data = block(body, "text/plain").replace(b"X-Other", codings.encode() + b"\r\nX-Other")
        headers = [("WARC-Payload-Digest", warc.digest(digest_of))] if digest_of is not None else []
        return {r[1]: r for r in warc.derive({"record_id": "r", "block": data, "target_uri": "u", "warc_date": "d", "warc_headers": headers})}

    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(20_000)).encode()
    assert set(derived("Content-Encoding: br", b"\x01\x02")) == {"metadata"}
    cut = derived("Content-Encoding: gzip", gzip.compress(text)[:4000])["conversion"][-1].encode()
    assert len(cut) > 1000 and text.startswith(cut)
    bad = bytearray(gzip.compress(text))
    bad[-6] ^= 255
    assert derived("Content-Encoding: gzip", bytes(bad))["conversion"][-1].encode() == text
    part = derived("Transfer-Encoding: chunked", chunked(text, 900)[:5000])["conversion"][-1].encode()
    assert len(part) > 4500 and text.startswith(part)
    assert derived("Transfer-Encoding: chunked", b"10 apples\r\nand pears")["conversion"][-1] == "10 apples\r\nand pears"
    assert derived("Transfer-Encoding: chunked", b"")["conversion"][-1] == ""
    # A digest of the joined body holds as well as one of the chunks.
    assert derived("Transfer-Encoding: chunked", chunked(text), text)["conversion"][13] is True
    assert derived("Transfer-Encoding: chunked", chunked(text), b"other")["conversion"][13] is False
