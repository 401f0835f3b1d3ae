"""Secret scan with structural confirmation.

Patterns give the plain findings (``assign``, ``access``, ``hex``). Beyond them, text that looks like an encoded
key is decoded and parsed, and reported only when its structure holds: a private-key block or a base64 or hex run
whose bytes are nested DER or an OpenSSH key whose declared lengths fit (``key``), and a signed token whose header
is JSON naming an algorithm (``jwt``). Base64 may be wrapped over lines, also as a string literal with escaped line breaks,
with or without the lines of a block; a block may have header lines, and if they say that it is encrypted, its body has no
structure and must decode to whole cipher blocks. Hex may mix cases. Spans are code points of the whole text, end exclusive.

NULL and empty texts have no spans (zero counts, the digest of the empty string, empty ``spans``). Repeated rows give
repeated results; other columns of the input are not read, so their names do not matter.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from shelfscope.llm.common import batch_of, out_schema, over_texts

KINDS = ("assign", "access", "hex", "key", "jwt")
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs are whole, so a bound in the pattern equals a check after it
# A line break, as such or as a string literal spells it.
_BREAK = r"(?:\s|\\r|\\n)"
_BLOCK = re.compile(
    rf"-----BEGIN ([A-Z0-9 ]{{0,40}}PRIVATE KEY)-----{_BREAK}*((?:[A-Za-z][A-Za-z0-9-]*:(?:(?!\\[rn])[^\r\n])*{_BREAK}+)*)((?:[A-Za-z0-9+/=]|{_BREAK})+)-----END \1-----"
)
# Base64 of an opening brace, a white space or nothing, and a quote.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
# Full lines of base64 and a last one; each of 16 characters or more, so that prose is none.
_WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{{32,}}(?:{_BREAK}{{1,4}}[A-Za-z0-9+/]{{32,}})*(?:{_BREAK}{{1,4}}[A-Za-z0-9+/]*={{0,2}})?")
_LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}(?![0-9A-Fa-f])")
_CIPHER_BLOCK = 8  # bytes; longer blocks are multiples of it
_HINTS = ("assw", "secret", "token", "api")
SHORTEST_RUN = 20  # no kind but ``assign`` has a shorter run without white space; a key block starts with dashes


def der_members(data: bytes, start: int, stop: int, depth: int = 0) -> int | None:
    """Number of elements that fill data[start:stop] exactly with nested lengths that fit; None otherwise."""
    count = 0
    while start < stop:
        if start + 2 > stop or data[start] & 0x1F == 0x1F:
            return None
        tag, length, at = data[start], data[start + 1], start + 2
        if length & 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > stop:
                return None
            length, at = int.from_bytes(data[at : at + size], "big"), at + size
        if at + length > stop:
            return None
        if tag & 0x20 and (depth > 8 or der_members(data, at, at + length, depth + 1) is None):
            return None
        start, count = at + length, count + 1
    return count


def _ssh_lengths_fit(data: bytes) -> bool:
    at = len(b"openssh-key-v1\0")
    for _ in range(3):  # cipher, key derivation, its options
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 8 <= len(data) and at + 8 + int.from_bytes(data[at + 4 : at + 8], "big") <= len(data)


def is_key(data: bytes) -> bool:
    """Whether decoded bytes are a key: one DER sequence of two or more members, the first an integer, an object
    or a sequence, or an OpenSSH private key."""
    if data.startswith(b"openssh-key-v1\0"):
        return _ssh_lengths_fit(data)
    if len(data) < 24 or data[0] != 0x30 or der_members(data, 0, len(data)) != 1:
        return False
    head = 2 + (data[1] & 0x7F if data[1] & 0x80 else 0)
    inner = der_members(data, head, len(data))
    return inner is not None and inner >= 2 and data[head] in (0x02, 0x06, 0x30)


def _base64(text: str) -> bytes | None:
    plain = re.sub(_BREAK, "", text).translate(str.maketrans("-_", "+/")).rstrip("=")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _is_token_header(text: str) -> bool:
    data = _base64(text)
    try:
        header = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def base_spans(text: str, long_runs: bool = True) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of the plain patterns."""
    low = text.lower()
    if any(h in low for h in _HINTS):
        yield from ((m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6)
    if long_runs:
        if "AKIA" in text:
            yield from ((m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20)
        yield from ((m.start(), 2, m.end()) for m in _HEX.finditer(text))


def confirmed_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of candidates whose decoded structure holds; a run inside a key block counts once."""
    blocks = []
    if "PRIVATE KEY-----" in text:
        for m in _BLOCK.finditer(text):
            if (data := _base64(m[3])) and (_is_encrypted(m[2], data) or is_key(data)):
                blocks.append(m.span())
                yield m.start(), 3, m.end()
    for m in _JWT.finditer(text) if "ey" in text or "ew" in text else ():
        if _is_token_header(m[1]):
            yield m.start(), 4, m.end()
    seen = set()
    for m in _LONG_HEX.finditer(text):
        if (m.end() - m.start()) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            seen.add(m.span())
            yield m.start(), 3, m.end()
    for m in _BASE64.finditer(text):
        inside = any(a <= m.start() and m.end() <= b for a, b in blocks)
        if not inside and m.span() not in seen and (data := _base64(m[0])) and is_key(data):
            blocks.append(m.span())
            yield m.start(), 3, m.end()
    for m in _WRAPPED.finditer(text):
        if any(a < m.end() and m.start() < b for a, b in blocks) or not re.search(_BREAK, m[0]):
            continue
        if end := _key_length(text, m.start(), m.end()):
            yield m.start(), 3, end


def _is_encrypted(headers: str, data: bytes) -> bool:
    """The headers of a block name a cipher, and its body is made of whole blocks of one."""
    return "ENCRYPTED" in headers and "DEK-Info:" in headers and len(data) >= 64 and len(data) % _CIPHER_BLOCK == 0


def _key_length(text: str, start: int, stop: int) -> int | None:
    """Where a key that begins with wrapped base64 at ``start`` ends by the length that it declares; None without a key.

    What follows a key may look like base64 too, so the first bytes say how much of the stretch belongs to it.
    """
    places = [(i, text[i]) for i in _base64_places(text, start, stop)]
    head = _base64("".join(c for _, c in places[:32]))
    if not head or head[0] != 0x30 or len(head) < 8:
        return None
    size = head[1] & 0x7F if head[1] & 0x80 else 0
    if size > 4:
        return None
    length = 2 + size + (int.from_bytes(head[2 : 2 + size], "big") if size else head[1])
    chars = -(-length * 4 // 3)
    if chars > len(places) or not (data := _base64("".join(c for _, c in places[:chars]))) or not is_key(data[:length]):
        return None
    end = places[chars - 1][0] + 1
    while end < stop and text[end] == "=":
        end += 1
    return end


def _base64_places(text: str, start: int, stop: int) -> Iterator[int]:
    """Places of the base64 characters; an escaped line break is none of them."""
    i = start
    while i < stop:
        if text[i] == "\\":
            i += 2
        else:
            if not text[i].isspace() and text[i] != "=":
                yield i
            i += 1


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _work(part: pa.RecordBatch, texts: list) -> pa.RecordBatch:
    counts: tuple[list, ...] = ([], [], [])
    digests, spans = [], []
    for text in texts:
        base: list = []
        more: list = []
        if text:
            long_runs = max(map(len, text.split()), default=0) >= SHORTEST_RUN
            base = list(base_spans(text, long_runs))
            if long_runs or "-----BEGIN" in text:
                more = list(confirmed_spans(text))
        for kind, column in enumerate(counts):
            column.append(sum(k == kind for _, k, _ in base))
        digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
        spans.append(_joined(base + more))
    return batch_of(part.column("doc_id"), n_assign=pa.array(counts[0], pa.int64()), n_access=pa.array(counts[1], pa.int64()),
                    n_hex=pa.array(counts[2], pa.int64()), base_sha256=pa.array(digests, pa.string()), spans=pa.array(spans, pa.string()))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document with its findings; a narrow plan without a shuffle."""
    schema = out_schema(docs, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return over_texts(docs, lambda: _work, schema)
