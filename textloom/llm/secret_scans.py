"""Secret scans with structural confirmation.

Three base kinds are reported as matched: ``assign`` (a secret-like name and its value),
``access`` (AKIA identifiers) and ``hex`` (32 or more hex digits). Further spans are reported
only if their decoded bytes have the structure of a secret: ``jwt`` (a base64url header that
is a JSON object with "alg"), ``pem`` (a PRIVATE KEY block whose base64 decodes to DER with
consistent nested lengths or to an openssh-key-v1 container, or whose header lines name a
cipher that the length of the body fits; line ends may be written as \\n) and ``der`` (a bare
run of base64, base64url or hex digits of either case that holds such a key; base64 may go over
lines and stand behind other characters). A key is a private one of PKCS#1, SEC1, DSA, PKCS#8 in
the clear or encrypted, or OpenSSH's, of at most MOST_KEY bytes in base64: public keys,
certificates, digests and signatures are none.

Spans are half-open and count code points. Defined results: null and empty texts have no
spans; a text of any length is scanned whole, in time proportional to it, also where key
blocks or tokens are cut off; equal starts go by kind; repeated rows are scanned one by one;
an empty table gives no rows; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

KINDS = ("assign", "access", "hex", "jwt", "pem", "der")
BASE_KINDS = KINDS[:3]

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Every hex run of 32 and base64 run of 40 lies within such a run.
LONG = re.compile(r"[A-Za-z0-9+/=_.-]{32,}")
NAMES = ("passw", "secret", "token", "apikey", "api_key")
#: Runs that may hold signed tokens: three parts with dots between.
DOTTED = re.compile(r"[A-Za-z0-9_.-]+")
#: Runs of base64 of either alphabet, over line ends of one kind if the first line is long.
LINES = re.compile(r"[A-Za-z0-9+/_-]{48,}(?:(?:\n[A-Za-z0-9+/_-]+)+|(?:\r\n[A-Za-z0-9+/_-]+)+)?|[A-Za-z0-9+/_-]{32,47}")
KEY = re.compile(r"M[A-I]|b3BlbnNzaC1r")
URL_SAFE = str.maketrans("-_", "+/")
PADDING = re.compile(r"={0,2}")
#: Bytes of a key: what two bytes of length can say.
MOST_KEY = 1 << 16
#: Base64 of the beginnings of a JSON object; characters of a header; an object's first name.
OBJECT = re.compile(r"ey[IJA]|ew[0ko]")
HEADER = 1 << 14
#: Characters of the shortest header: an algorithm of no letters.
SHORTEST = len(base64.urlsafe_b64encode(b'{"alg":""}').rstrip(b"="))
NAMED = re.compile(rb'\{\s*"(?:[^"\\]|\\.)*(?:"\s*(?::|\Z)|\Z)', re.S)
ANY_HEX = re.compile(r"[0-9A-Fa-f]{48,}")
BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----")
CIPHER = re.compile(r"DEK-Info: ?[A-Z0-9-]+,([0-9A-Fa-f]+)")
OPENSSH = b"openssh-key-v1\0"


def der_fills(data: bytes, depth: int = 0) -> bool:
    """Whether data is a row of complete DER values; constructed ones are looked into."""
    at, n = 0, len(data)
    while at < n:
        if at + 2 > n:
            return False
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            k = length & 0x7F
            if not 1 <= k <= 4 or at + k > n:
                return False
            length = int.from_bytes(data[at : at + k], "big")
            at += k
            if length < 0x80:
                return False
        if at + length > n:
            return False
        if tag & 0x20 and (depth > 16 or not der_fills(data[at : at + length], depth + 1)):
            return False
        at += length
    return True


def members(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of the values of a SEQUENCE that is all of data; None where data is none."""
    if len(data) < 24 or data[0] != 0x30 or not der_fills(data):
        return None
    out, at = [], 2 + (data[1] & 0x7F if data[1] & 0x80 else 0)
    if at + (data[1] if at == 2 else int.from_bytes(data[2:at], "big")) != len(data):
        return None  # more values follow
    while at < len(data):
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            k = length & 0x7F
            length = int.from_bytes(data[at : at + k], "big")
            at += k
        out.append((tag, data[at : at + length]))
        at += length
    return out


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_key(data: bytes) -> bool:
    """A private key, by its structure: PKCS#1, DSA, SEC1, PKCS#8 in the clear or encrypted, or an OpenSSH container."""
    if data.startswith(OPENSSH):
        return 0 < openssh_size(data) <= len(data)
    got = members(data)
    if not got:
        return False
    tags, first = [t for t, _ in got], got[0][1]
    if tags[0] == INTEGER:
        if all(t == INTEGER for t in tags):
            return len(tags) == 9 and first in (b"\0", b"\1") or len(tags) == 6 and first == b"\0"
        if tags == [INTEGER] * 9 + [SEQUENCE]:  # more than two primes
            return first == b"\1"
        options = tags[3:] if tags[1] == SEQUENCE else tags[2:]
        if not all(t & 0xC0 == 0x80 for t in options):
            return False
        if tags[1] == OCTETS:
            return first == b"\1"
        return len(tags) > 2 and tags[1:3] == [SEQUENCE, OCTETS] and first in (b"\0", b"\1") and got[1][1][:1] == bytes([OID])
    # encrypted: an algorithm with parameters (a digest's are null), then the sealed bytes
    if tags == [SEQUENCE, OCTETS] and first[:1] == bytes([OID]) and len(first) > 2:
        return first[2 + first[1] :][:1] == bytes([SEQUENCE])
    return False


def openssh_size(data: bytes) -> int:
    """Bytes of the container at the start of data: names of cipher and derivation, its options, keys, sealed part; 0 if there is none."""
    at, left = len(OPENSSH), 3
    while left:
        if at + 4 > len(data):
            return 0
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        left -= 1
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if at > len(data) or not 0 < keys <= 16:
        return 0
    for _ in range(keys + 1):
        if at + 4 > len(data):
            return 0
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at


def _decoded(run: str, url: bool = False) -> bytes:
    run = run.rstrip("=")
    try:
        data = (run + "=" * (-len(run) % 4)).encode()
        return base64.b64decode(data, altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return b""


def is_signed_token(header: str) -> bool:
    """Whether a token's first part is a JSON object that names an algorithm."""
    data = _decoded(header, url=True)
    if b'"alg"' not in data:
        return False
    try:
        got = json.loads(data)
    except (ValueError, RecursionError):
        return False
    return isinstance(got, dict) and isinstance(got.get("alg"), str)


def signed_tokens(run: str) -> Iterator[tuple[int, int]]:
    """Places of tokens in a run of dotted parts. A header may stand behind other characters of its part, within HEADER of its end."""
    parts = run.split(".")
    starts = [0]
    for x in parts:
        starts.append(starts[-1] + len(x) + 1)
    i = 0
    while i + 2 < len(parts):
        part = parts[i]
        for m in OBJECT.finditer(part, max(0, len(part) - HEADER)) if parts[i + 1] else ():
            # an object begins with a name and a colon, which most of a repeated beginning does not have
            if len(part) - m.start() >= SHORTEST and NAMED.match(_decoded(part[m.start() : m.start() + 64], url=True)) and is_signed_token(part[m.start() :]):
                yield starts[i] + m.start(), starts[i + 2] + len(parts[i + 2])
                i += 2
                break
        i += 1


def is_key_block(body: str) -> bool:
    """Whether what stands between a key's BEGIN and END marks is a key: header lines, an empty line and base64, or base64 alone."""
    lines = [x.strip() for x in body.replace("\\r", "\n").replace("\\n", "\n").split("\n")]
    heads = [x for x in lines if ":" in x]
    data = _decoded("".join(x for x in lines if ":" not in x).replace(" ", ""))
    if any(x.startswith("Proc-Type:") and x.endswith("ENCRYPTED") for x in heads):
        iv = next((m[1] for x in heads if (m := CIPHER.fullmatch(x))), "")
        # the initial vector is as long as a block of the cipher
        return len(iv) in (16, 32) and len(data) > 0 and len(data) % (len(iv) // 2) == 0
    return is_key(data)


def key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Places of PEM keys: nothing between the marks has five dashes, so the next five must begin the END mark."""
    for m in BEGIN.finditer(text):
        end, mark = text.find("-----", m.end()), f"-----END {m[1]}-----"
        if end >= 0 and text.startswith(mark, end) and is_key_block(text[m.end() : end]):
            yield m.start(), end + len(mark)


def bare_hex_keys(run: str) -> Iterator[tuple[int, int]]:
    """Places of keys in a run of hex digits."""
    for m in ANY_HEX.finditer(run):
        if m[0].startswith("30") and len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            yield m.span()


def _key_at(run: str, at: int) -> int:
    """Where the key that begins at a place of a base64 run ends; 0 if none does. What a key says of its length tells how much to decode."""
    head = _decoded(run[at : at + 16])
    if head.startswith(OPENSSH[:12]):
        size = openssh_size(_decoded(run[at : at + min(4 * MOST_KEY // 3, len(run) - at) // 4 * 4]))
    elif len(head) < 12 or head[0] != SEQUENCE:
        return 0
    else:
        k = head[1] & 0x7F if head[1] & 0x80 else 0
        inner = head[2 + k : 5 + k]
        if k > 2 or not (inner[:2] == b"\2\1" and inner[2] < 2 or inner[:1] == bytes([SEQUENCE])):
            return 0
        size = 2 + k + (int.from_bytes(head[2 : 2 + k], "big") if k else head[1])
    end = at + -(-4 * size // 3)
    if not 0 < size <= MOST_KEY or end > len(run) or not is_key(_decoded(run[at:end])[:size]):
        return 0
    return end


def bare_keys(text: str) -> Iterator[tuple[int, int]]:
    """Places of keys in base64 or base64url without marks: within one run, also behind other characters of it, or over lines."""
    for m in LINES.finditer(text):
        raw, run, starts = m[0], m[0], [0]
        if "\n" in raw:
            lines = raw.splitlines(keepends=True)
            run = "".join(x.rstrip("\r\n") for x in lines)
            for x in lines:
                starts.append(starts[-1] + len(x.rstrip("\r\n")))
        plain, at = run.translate(URL_SAFE), 0
        # a key's bytes begin with 30 and a length, or with OpenSSH's name
        while found := KEY.search(plain, at):
            if end := _key_at(plain, found.start()):
                place = lambda p: m.start() + p + (_breaks(raw, starts, p) if run is not raw else 0)  # noqa: B023, E731
                last = place(end - 1) + 1
                yield place(found.start()), last + len(PADDING.match(text, last)[0])
                at = end
            else:
                at = found.start() + 1


def _breaks(raw: str, starts: list[int], place: int) -> int:
    """Characters of line ends before a place of the joined lines."""
    line = bisect.bisect_right(starts, place) - 1
    return line * (2 if "\r\n" in raw else 1)


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """All spans as (start, kind's place in KINDS, end), sorted."""
    found: list[tuple[int, int, int]] = []
    text = text or ""
    low = text.lower()
    if any(x in low for x in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    long = False
    for run in LONG.finditer(text):
        at, part, long = run.start(), run[0], True
        # a run of hex digits goes on to neither side: all its characters are in LONG's class
        found += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(part) if m.end() - m.start() >= 32]
        if len(part) >= 48:
            found += [(at + a, 5, at + z) for a, z in bare_hex_keys(part)]
    if long:
        found += [(a, 5, z) for a, z in bare_keys(text)]
    if OBJECT.search(text):
        found += [(m.start() + a, 3, m.start() + z) for m in DOTTED.finditer(text) if OBJECT.search(m[0]) for a, z in signed_tokens(m[0])]
    if "PRIVATE KEY-----" in text:
        found += [(a, 4, z) for a, z in key_blocks(text)]
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str | None, mask: str = "[secret]") -> str | None:
    """The text with every span replaced; overlapping spans are replaced together."""
    if not text or not (spans := scan(text)):
        return text
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


SCHEMA = "id {}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base spans, a digest of them, and all spans, one row for each document."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(x.as_py()) for x in batch.column(1)]
            base = [[s for s in r if s[1] < 3] for r in rows]
            counts = [pa.array([sum(s[1] == k for s in r) for r in rows], pa.int64()) for k in range(3)]
            digest = pa.array([hashlib.sha256(written(r).encode()).hexdigest() for r in base], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, digest, pa.array([written(r) for r in rows], pa.string())],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, SCHEMA.format(id_type.simpleString())).withColumnRenamed("id", "doc_id")


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with all secrets in their texts masked; n_chars, where there is one, follows."""

    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                texts = pa.array([redact(x.as_py()) for x in batch.column(at)], batch.column(at).type)
                yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    out = docs.mapInArrow(lean(run), docs.schema)
    if "n_chars" in names and text_col == "text":
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(names)
