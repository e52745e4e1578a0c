"""Metadata and plain-text conversion records derived from WARC response records.

For each response: a ``metadata`` record (application/warc-fields: HTTP status, content type,
charset, language, title, outlinks), and, if the payload is text, a ``conversion`` record with its
plain text. Both name the response in ``refers_to``, with its target and date, keep its headers and
digests, and are tied to each other by ``concurrent_to``; their own ids are made from the response's
id, so a second run makes the same records. Digests of the source are checked, not trusted.

Chunked, gzip and deflate bodies are decoded before their text is taken; digests are those of the
stored bytes. One pass without a shuffle; a page is handled by itself, so nothing in it depends on
other rows, and a very long one takes time in proportion to its decoded length, in one task.

Defined results: a null or empty block, or one without an HTTP head, gives a metadata record only,
with status null; bytes that are not valid in the charset are replaced; an unknown charset is read
as UTF-8; a null record id gives records whose own ids are null; repeated rows give repeated records;
a body that is not in the coding its header names is read as it is, a broken one as far as it goes,
and one in a coding that is not known gives a metadata record only. Columns of other names pass unread.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

RECORD = ("record_id string, warc_type string, refers_to string, refers_to_target_uri string, "
          "refers_to_date string, concurrent_to string, target_uri string, warc_date string, "
          "content_type string, content_length long, block_digest string, source_payload_digest string, "
          "source_block_digest string, source_digests_hold boolean, source_headers string, http_headers string, "
          "block string")
_NAMES = [x.split()[0] for x in RECORD.split(", ")]
_KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
_SCHEMA = pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in RECORD.split(", "))])

# Only comments, scripts and styles without an end run to the end of the page; a self-closed svg is gone alone.
_OPENING = re.compile(r"<!--|<(?:script|style|noscript|template|svg)(?=[\s/>])", re.I)
_CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "svg")}
_ALONE = re.compile(r"<svg(?:\s[^<>]*)?/>", re.I)
_REST = re.compile(r"[^<>]*>")
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|"
                    r"h[1-6]|header|hr|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[A-Za-z/!?][^<>]*>")
_SPACE = re.compile(r"\s+")
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_TITLE, _TITLE_END = re.compile(r"<title\b[^<>]*>", re.I), re.compile("</title", re.I)
_LANG = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_LINK = re.compile(r"<(a|img|link|script|iframe)\b[^<>]*?\b(href|src)\s*=\s*(?:\"([^\"<>]*)\"|'([^'<>]*)')", re.I)
_CHUNK = re.compile(rb"[ \t]*([0-9A-Fa-f]{1,16})[ \t]*(?:;[^\r\n]*)?")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def _shown(page: str) -> str:
    """The page without what is not shown. Tags are met once, in order; a name whose closing tag was
    looked for in vain is not looked for again, so the time grows with the page alone."""
    out, done, at, unclosed = [], 0, 0, set()
    while opening := _OPENING.search(page, at):
        name, at = opening[0][1:].lower(), opening.end()
        if name == "!--":
            end = page.find("-->", at)
            end = len(page) if end < 0 else end + 3
        elif name in ("script", "style"):
            closing = _CLOSING[name].search(page, at)
            end = closing.end() if closing else len(page)
        elif name == "svg" and (alone := _ALONE.match(page, opening.start())):
            end = alone.end()
        else:
            rest = None if name in unclosed else _REST.match(page, at)
            closing = _CLOSING[name].search(page, rest.end()) if rest else None
            if not closing:
                if rest:
                    unclosed.add(name)
                continue
            end = closing.end()
        out.append(page[done:opening.start()])
        done = at = end
    return " ".join([*out, page[done:]])


def _title(page: str) -> str:
    opening = _TITLE.search(page)
    closing = opening and _TITLE_END.search(page, opening.end())
    return page[opening.end():closing.start()] if closing else ""


def plain_text(page: str) -> str:
    """The words of a page, one line per block."""
    flat = _SPACE.sub(" ", _shown(page))
    text = html.unescape(_TAG.sub("", _BREAK.sub("\n", flat)))
    return _LINES.sub("\n", _BLANK.sub(" ", text)).strip()


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _same_digest(claimed: str | None, data: bytes) -> bool | None:
    """Whether a labelled SHA-1 (base 32 or hex) is that of the data; None where there is none."""
    label, _, value = (claimed or "").partition(":")
    if label.lower() != "sha1" or not value:
        return None
    return value in (digest(data)[5:], hashlib.sha1(data).hexdigest())


def split_http(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """Status, headers and payload of an HTTP response."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("iso-8859-1").split("\r\n")
    status = re.match(r"HTTP/\d(?:\.\d)? (\d{3})", first)
    if not gap or not status:
        return None, [], b""
    pairs = [x.partition(":")[::2] for x in lines if ":" in x]
    return int(status[1]), [(k.strip(), v.strip()) for k, v in pairs], payload


def _unchunked(data: bytes) -> bytes | None:
    """The data of a chunked body, as far as it goes; None where it does not begin with a chunk, as
    in crawls that store the body joined and keep the header."""
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\r\n", at, at + 1024)
        size = _CHUNK.fullmatch(data, at, end) if end >= 0 else None
        if not size:
            return b"".join(out) if out else None
        n = int(size[1], 16)
        if n == 0:
            return b"".join(out)
        stop = end + 2 + n
        if stop < len(data) and not b"\r\n".startswith(data[stop:stop + 2]):
            return b"".join(out) if out else None
        out.append(data[end + 2:stop])
        at = stop + 2
    return b"".join(out) if out else None


def _inflated(data: bytes, window: int) -> bytes | None:
    """Members one after another, the last as far as it goes; None where none begins."""
    out = []
    while data:
        member = zlib.decompressobj(window)
        try:
            out.append(member.decompress(data) + member.flush())
        except zlib.error:
            # What stands before the broken place is had byte by byte only.
            member = zlib.decompressobj(window)
            try:
                for at in range(len(data)):
                    out.append(member.decompress(data[at:at + 1]))
            except zlib.error:
                pass
            return b"".join(out) or None
        data = member.unused_data  # bytes behind the last member that begin none are padding
    return b"".join(out)


def decoded(http: list[tuple[str, str]], payload: bytes) -> tuple[bytes, bytes | None]:
    """The body without its transfer coding, and without its content codings (gzip, deflate): None
    if one of them is not known. A body that is not in the coding its header names is left as it is."""
    def named(header: str) -> list[str]:
        return [x.strip().lower() for k, v in http if k.lower() == header for x in v.split(",") if x.strip()]

    body, unchunked = payload, False
    for coding in [*reversed(named("transfer-encoding")), None, *reversed(named("content-encoding"))]:
        if coding is None:
            payload, unchunked = body, True
            continue
        if coding == "identity" or not body:
            continue
        if coding == "chunked":
            plain = _unchunked(body)
        elif coding in ("gzip", "x-gzip"):
            plain = _inflated(body, 31)
        elif coding == "deflate":
            plain = _inflated(body, 15) or _inflated(body, -15)
        else:
            return (payload if unchunked else body), None
        body = body if plain is None else plain
    return payload, body


def _own_id(kind: str, source: str | None) -> str | None:
    return None if source is None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} of {source}')}>"


def _one_line(x: str) -> str:
    return " ".join(html.unescape(x).split())


def derive(record: dict) -> Iterator[tuple]:
    """The records derived from one response."""
    source, block = record["record_id"], record["block"] or b""
    headers = dict(record["warc_headers"] or [])
    status, http, payload = split_http(block)
    content_type = next((v for k, v in http if k.lower() == "content-type"), "")
    kind = content_type.partition(";")[0].strip().lower()
    claimed = {n: next((v for k, v in headers.items() if k.lower() == f"warc-{n}-digest"), None)
               for n in ("payload", "block")}
    body, plain = decoded(http, payload)
    # Crawlers take the payload's digest with its transfer coding or without.
    held = [_same_digest(claimed["payload"], x) for x in (payload, body)]
    checks = [c for c in (held[0] or held[1], _same_digest(claimed["block"], block)) if c is not None]
    payload = plain or b""
    charset = (_CHARSET.search(content_type) or _CHARSET.search(payload[:1024].decode("ascii", "replace")) or [None, "utf-8"])[1]
    try:
        page = payload.decode(charset, "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    page = page.encode("utf-8", "replace").decode("utf-8")
    is_html, is_text = kind in ("text/html", "application/xhtml+xml"), kind.startswith("text/")
    fields = [("http-status", "" if status is None else str(status)), ("content-type", content_type),
              ("charset", charset)]
    if is_html:
        lang = _LANG.search(page)
        fields += [("title", _one_line(_title(page))), ("language", lang[1] if lang else "")]
        fields += [("outlink", f"{_one_line(a or b)} {tag.lower()}/@{how.lower()}")
                   for tag, how, a, b in _LINK.findall(_shown(page))]
    blocks = [("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields))]
    if status is not None and plain is not None and (is_html or is_text):
        blocks.append(("conversion", "text/plain; charset=utf-8", plain_text(page) if is_html else page))
    ids = {k: _own_id(k, source) for k, _, _ in blocks}
    for name, mime, body in blocks:
        data = body.encode("utf-8")
        other = next((i for k, i in ids.items() if k != name), None)
        yield (ids[name], name, source, record["target_uri"], record["warc_date"], other,
               record["target_uri"], record["warc_date"], mime, len(data), digest(data),
               claimed["payload"], claimed["block"], all(checks) if checks else None,
               "".join(f"{k}: {v}\r\n" for k, v in sorted(headers.items())),
               "".join(f"{k}: {v}\r\n" for k, v in http), body)


def _derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [r for record in batch.to_pylist() for r in derive(record)]
        columns = list(zip(*rows)) or [[]] * len(_NAMES)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def derivatives(responses: DataFrame) -> DataFrame:
    """Metadata and conversion records of responses (record_id, target_uri, warc_date, warc_headers:
    map of text to text, block: binary)."""
    return responses.select("record_id", "target_uri", "warc_date", "warc_headers", "block").mapInArrow(
        _derived, RECORD)


def responses(pages: DataFrame) -> DataFrame:
    """Crawled pages as WARC response records, as a crawler would have written them."""
    body = F.coalesce("html", F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("body"), F.concat(head, body).alias("block"))
    key = F.md5(F.concat_ws(" ", F.col("page_id").cast("string"), "url"))
    record_id = F.regexp_replace(key, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")
    date = F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(
        F.coalesce("page_id", F.lit(0)), F.lit(31_536_000))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select(record_id.alias("record_id"), F.col("url").alias("target_uri"), date.alias("warc_date"),
                       F.create_map(F.lit("WARC-Type"), F.lit("response"),
                                    F.lit("WARC-Payload-Digest"), F.concat(F.lit("sha1:"), F.sha1("body")),
                                    F.lit("WARC-Block-Digest"), F.concat(F.lit("sha1:"), F.sha1("block")),
                                    F.lit("Content-Type"), F.lit("application/http; msgtype=response")
                                    ).alias("warc_headers"), "block")
