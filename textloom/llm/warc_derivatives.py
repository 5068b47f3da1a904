"""WARC derivatives: metadata and plain-text conversion records linked to responses.

Each response gives one ``metadata`` record (application/warc-fields: title, language, link
and text counts, HTTP status and the HTTP headers) and one ``conversion`` record (text/plain).
Both keep the response's target URI, date and those of its WARC headers that hold for what is
derived (CARRIED), name it in WARC-Refers-To, repeat its payload digest in
WARC-Source-Payload-Digest, and carry digests of their own blocks. Identifiers are name-based
UUIDs of what they stand for, so reruns agree.

Defined results: a null URL is written as ``about:blank``, null HTML as an empty payload; blanks
and control characters of a URL are written as %XX; a page of any length is read in time
proportional to it, also where tags, comments or scripts are not closed (an unclosed comment or
script is a tag, an unclosed tag is text); repeated rows have the same identifiers, so have
different pages of one URL and HTML; an empty table gives no rows; other columns, whatever their
names, are left alone. A record that is cut short, whose lengths or digests disagree, or whose
response is no HTTP gives a row with ``error`` in ``derive_records``, and reading goes on at the
next record.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The date of all records: the tables carry none.
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:textloom:warc")

#: Headers of a response that its derived records keep.
CARRIED = ("WARC-IP-Address", "WARC-Warcinfo-ID", "WARC-Concurrent-To", "WARC-Identified-Payload-Type", "WARC-Page-ID")
#: The names as they are written, by their lower-case form: names of headers have no case.
NAMES = {x.lower(): x for x in (*CARRIED, "WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Block-Digest", "WARC-Refers-To", "WARC-Source-Payload-Digest", "Content-Type", "Content-Length")}

HIDING = frozenset(("script", "style", "noscript", "template"))
BREAKING = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 tr table article section nav header footer title blockquote pre".split())
MARK = re.compile(r"<(?:(!--)|(/?)([A-Za-z][A-Za-z0-9]*)|/?[A-Za-z!?])")
CLOSING = {x: re.compile(rf"</{x}\b", re.I) for x in (*sorted(HIDING), "title")}
LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
HREF = re.compile(r"\shref\s*=", re.I)
LONG_REFERENCE = re.compile(r"&#(?:[0-9]{9,}|[xX][0-9A-Fa-f]{9,});?")
CHARSET = re.compile(rb"charset=[\"']?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_fits(written: str, data: bytes) -> bool:
    """Whether a digest header is that of data; algorithms other than SHA-1, SHA-256 and MD5 are not held against it."""
    kind, _, value = written.partition(":")
    kind = kind.strip().lower().replace("-", "")
    if kind not in ("sha1", "sha256", "md5"):
        return True
    raw = hashlib.new(kind, data).digest()
    return value.strip() in (base64.b32encode(raw).decode(), base64.b32encode(raw).decode().rstrip("="), raw.hex(), raw.hex().upper())


def record_id(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(names))}>"


def uri(written: str) -> str:
    """A URI as a header can hold it: blanks and control characters as %XX."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", written)


def write_record(headers: dict[str, str], block: bytes) -> bytes:
    """Headers of one name, by line ends in the value, are written line by line."""
    lines = [f"{k}: {x.strip()}" for k, v in headers.items() for x in v.splitlines() or [""]]
    return ("WARC/1.1\r\n" + "\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def read_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """The record at a byte: headers, block and where the next one begins."""
    if not data.startswith(b"WARC/1.", at):
        raise ValueError(f"no WARC record at byte {at}")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise ValueError(f"the headers at byte {at} do not end")
    headers: dict[str, str] = {}
    for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        name = NAMES.get(name.strip().lower(), name.strip())
        headers[name] = f"{headers[name]}\n{value.strip()}" if name in headers else value.strip()
    length = headers.get("Content-Length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 16):
        raise ValueError(f"the record at byte {at} has no length")
    last = end + 4 + int(length)
    if data[last : last + 4] != b"\r\n\r\n":
        raise ValueError(f"a record's length disagrees at byte {last}")
    return headers, data[end + 4 : last], last + 4


def read_records(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """All records of a WARC, as headers and block. Raises ValueError at the first broken one."""
    out, at = [], 0
    while at < len(data):
        headers, block, at = read_record(data, at)
        out.append((headers, block))
    return out


#: What a record begins with.
START = re.compile(rb"WARC/1\.[0-9]\r\n")


def sound_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Records of a WARC; for a broken one its error, and reading goes on where the next one seems to begin.

    Linear in the data: the end of a header is looked for once, and a header is broken if another record begins before it.
    """
    at, end = 0, 0
    while 0 <= at < len(data):
        if 0 <= end < at + 4:
            end = data.find(b"\r\n\r\n", at)
        inner = START.search(data, at + 1, end if end >= 0 else len(data))
        try:
            if inner or end < 0:
                raise ValueError(f"the headers at byte {at} do not end")
            headers, block, at = read_record(data, at)
            yield headers, block, None
        except ValueError as e:
            yield {}, b"", str(e)
            following = inner or START.search(data, at + 1)
            at = following.start() if following else -1


def response(url: str | None, html: str | None) -> bytes:
    """A response record of a page, with its HTTP headers."""
    url, payload = uri(url or "about:blank"), (html or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload
    return write_record(
        {
            "WARC-Type": "response", "WARC-Record-ID": record_id("response", url, digest(payload)), "WARC-Date": DATE, "WARC-Target-URI": url,
            "WARC-Payload-Digest": digest(payload), "WARC-Block-Digest": digest(block), "Content-Type": "application/http; msgtype=response",
        },
        block,
    )


def unescape(text: str) -> str:
    """Character references as characters; numbers beyond all characters as the replacement character."""
    try:
        return entities.unescape(text)
    except ValueError:  # more digits than an int may have
        return entities.unescape(LONG_REFERENCE.sub("\ufffd", text))


@dataclass
class Page:
    title: str = ""
    language: str = ""
    links: int = 0
    text: str = ""


def read_page(html: str) -> Page:
    """Title, language, links and visible text (lines by block element, white space collapsed, no empty lines).

    One pass from mark to mark; an end mark that is missing once is not looked for again.
    """
    page, out, at, named = Page(), [], 0, False
    missing: set[str] = set()

    def find(what: str, pattern: re.Pattern | str, start: int) -> int:
        if what in missing:
            return -1
        if isinstance(pattern, str):
            got = html.find(pattern, start)
        else:
            m = pattern.search(html, start)
            got = m.start() if m else -1
        if got < 0:
            missing.add(what)
        return got

    while m := MARK.search(html, at):
        end = find(">", ">", m.end())
        if end < 0:
            break
        out.append(html[at : m.start()])
        at = end + 1
        name = (m[3] or "").lower()
        opens = name and not m[2]
        if m[1]:
            close = find("-->", "-->", m.end())
            if close >= 0:
                out.append(" ")
                at = close + 3
            continue
        if opens and name in HIDING:
            close = find(name, CLOSING[name], at)
            last = find(">", ">", close) if close >= 0 else -1
            if last >= 0:
                out.append(" ")
                at = last + 1
            continue
        if opens:
            tag = html[m.end() : end]
            if name == "title" and not named:
                close = find("title", CLOSING["title"], at)
                named = close >= 0
                page.title = " ".join(unescape(html[at:close]).split()) if named else ""
            elif name == "html" and not page.language and (lang := LANG.search(tag)):
                page.language = lang[1].lower()
            elif name == "a" and HREF.search(tag):
                page.links += 1
        if name in BREAKING:
            out.append("\n")
    out.append(html[at:])
    lines = (" ".join(x.split()) for x in unescape("".join(out)).split("\n"))
    page.text = "\n".join(x for x in lines if x)
    return page


def plain_text(html: str) -> str:
    return read_page(html).text


def _decoded(payload: bytes, http: bytes) -> str:
    charset = CHARSET.search(http)
    try:
        return payload.decode(charset[1].decode() if charset else "utf-8", "replace")
    except (LookupError, UnicodeError):
        return payload.decode("utf-8", "replace")


def derived(headers: dict[str, str], block: bytes) -> list[bytes]:
    """The metadata and the conversion record of a response."""
    http, _, payload = block.partition(b"\r\n\r\n")
    first, *lines = http.decode("utf-8", "replace").split("\r\n")
    if not re.match(r"HTTP/\S+ \d{3}\b", first):
        raise ValueError(f"no HTTP response in {headers.get('WARC-Record-ID')}")
    if not all(x in headers for x in ("WARC-Record-ID", "WARC-Date", "WARC-Target-URI")):
        raise ValueError(f"a response lacks its identifier, date or URI: {headers}")
    source = headers.get("WARC-Payload-Digest") or digest(payload)
    if not digest_fits(source, payload):
        raise ValueError(f"payload digest disagrees in {headers['WARC-Record-ID']}")
    page = read_page(_decoded(payload, http))
    fields = [("title", page.title), ("language", page.language), ("outlinks", page.links), ("textLength", len(page.text)), ("httpStatus", first.split(" ", 2)[1])]
    fields += [(f"http-{name.strip().lower()}", value.strip()) for name, colon, value in (x.partition(":") for x in lines) if colon]
    shared = {"WARC-Date": headers["WARC-Date"], "WARC-Target-URI": headers["WARC-Target-URI"], "WARC-Refers-To": headers["WARC-Record-ID"], "WARC-Source-Payload-Digest": source}
    shared |= {k: headers[k] for k in CARRIED if k in headers}
    out = []
    for kind, content, body in (("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode()), ("conversion", "text/plain; charset=utf-8", page.text.encode("utf-8", "replace"))):
        own = {"WARC-Type": kind, "WARC-Record-ID": record_id(kind, headers["WARC-Record-ID"])}
        out.append(write_record(own | shared | {"WARC-Block-Digest": digest(body), "Content-Type": content}, body))
    return out


def derive(warc: bytes) -> list[bytes]:
    """For each response of a WARC its metadata and its conversion record. Raises ValueError where one is broken."""
    return [x for headers, block in read_records(warc) if headers.get("WARC-Type") == "response" for x in derived(headers, block)]


def derive_records(warcs: DataFrame, warc_col: str) -> DataFrame:
    """Rows of WARC bytes (any number of records each) to one row for each derived record: type, record_id,
    refers_to, target_uri and the record's bytes; for a broken record one row with its error alone."""
    names = ["type", "record_id", "refers_to", "target_uri", "record", "error"]

    def rows_of(warc: bytes) -> Iterator[tuple]:
        for headers, block, error in sound_records(warc):
            try:
                if error:
                    raise ValueError(error)
                made = derived(headers, block) if headers.get("WARC-Type") == "response" else []
            except ValueError as e:
                yield None, None, None, None, None, str(e)
                continue
            for record in made:
                ((h, _),) = read_records(record)
                yield h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Refers-To"], h["WARC-Target-URI"], record, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                cols = list(zip(*rows_of(x.as_py() or b""))) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (*[pa.string()] * 4, pa.binary(), pa.string()))], names=names)

    return warcs.select(F.col(warc_col)).mapInArrow(run, "type string, record_id string, refers_to string, target_uri string, record binary, error string")


RECORDS = "response binary, metadata binary, conversion binary"


def build_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Each page as its response record and the two records derived from it."""
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = [response(u.as_py(), h.as_py()) for u, h in zip(batch.column(1), batch.column(2))]
            rest = [derive(x) for x in first]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.binary()), pa.array([x[0] for x in rest], pa.binary()), pa.array([x[1] for x in rest], pa.binary())], names=["page_id", "response", "metadata", "conversion"])

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col), F.col(html_col)).mapInArrow(run, f"page_id {id_type}, {RECORDS}")


INDEX = "response_id string, metadata_id string, conversion_id string, metadata_refers_to string, conversion_refers_to string, target_uri string, payload_digest string, source_digest string, conversion_digest string, title string, n_links long, text_chars long, text_sha256 string, warc_bytes long"


def record_index(pages: DataFrame) -> DataFrame:
    """The records of each page written, read again and listed: page_id and the columns of INDEX."""
    id_type = pages.schema["page_id"].dataType.simpleString()

    def listed(url: str | None, html: str | None) -> tuple:
        warc = response(url, html)
        warc = b"".join([warc, *derive(warc)])
        (r, _), (m, fields), (c, text) = read_records(warc)
        of = dict(x.split(": ", 1) for x in fields.decode().split("\r\n") if x)
        return (r["WARC-Record-ID"], m["WARC-Record-ID"], c["WARC-Record-ID"], m["WARC-Refers-To"], c["WARC-Refers-To"], c["WARC-Target-URI"], r["WARC-Payload-Digest"], c["WARC-Source-Payload-Digest"], c["WARC-Block-Digest"], of["title"], int(of["outlinks"]), len(text.decode()), hashlib.sha256(text).hexdigest(), len(warc))

    names = [x.split()[0] for x in INDEX.split(", ")]
    kinds = [pa.int64() if x.endswith(" long") else pa.string() for x in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*[listed(u.as_py(), h.as_py()) for u, h in zip(batch.column(1), batch.column(2))])) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=["page_id", *names])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {id_type}, {INDEX}")
