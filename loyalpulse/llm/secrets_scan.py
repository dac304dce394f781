"""Secrets in texts: patterns, and encoded keys and tokens confirmed by their structure.

Base kinds are plain patterns.  The confirmed kinds start from base64 or hex candidates
that are decoded and reported only if what they hold parses to its last byte:

* ``token``: three base64url parts of which the first two are JSON objects, the first with
  a signing algorithm (a signed web token);
* ``key``: a DER sequence whose nested lengths add up and that starts as private or public
  keys and certificates do; an SSH public key; an OpenSSH private key file.  It may stand in
  one run, after 0x, wrapped over lines, or between BEGIN and END lines, whose line ends may
  be escaped as in JSON.

Every pattern takes time in proportion to the text, however long its runs of letters are.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import struct
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: In the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "token", "key")
BASE_KINDS = KINDS[:3]

_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
_URL_SAFE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
#: From a token's first dot: payload and signature.
_AFTER_HEADER = re.compile(r"\.(?=([A-Za-z0-9_-]{3,}+\.[A-Za-z0-9_-]*+))")
_ARMOR = re.compile(
    r"-----BEGIN ([A-Z0-9 ]{3,40})-----((?:[A-Za-z0-9+/=\s]|\\[nr])*+)-----END \1-----"
)
_LINE_END = re.compile(r"\\[nr]|\s+")
#: Lines of base64 or hex that follow each other; the last may be short.
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/])((?:[A-Za-z0-9+/]{32,}+\r?\n[\x20\t]*+)++)([A-Za-z0-9+/]*+={0,2}+)"
)
_HEX_ONLY = re.compile(r"(?:[0-9A-Fa-f]{2})++")
SHORTEST_VALUE = 8
SHORTEST_HEADER = 8

_SEQUENCE, _INTEGER, _OBJECT_ID = 0x30, 0x02, 0x06
_SSH_MAGIC = b"openssh-key-v1\0"
_SSH_NAMES = (b"ssh-", b"ecdsa-sha2-", b"sk-ssh-", b"sk-ecdsa-")


def _unbase64(text: str) -> bytes | None:
    bare = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(bare) % 4 == 1:
        return None
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except binascii.Error:
        return None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """Tag, start and end of the DER elements that fill ``data[at:end]`` exactly."""
    found = []
    while at < end:
        if end - at < 2:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or end - at < width or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
            if size < 0x80:
                return None
        if end - at < size:
            return None
        found.append((tag, at, at + size))
        at += size
    return found


def _nested(data: bytes, at: int, end: int, depth: int = 0) -> list[tuple[int, int, int]] | None:
    """As ``_elements``, with every nested sequence checked as well."""
    parts = _elements(data, at, end) if depth < 24 else None
    if parts and all(t != _SEQUENCE or _nested(data, a, b, depth + 1) for t, a, b in parts):
        return parts
    return None


def is_der_key(data: bytes) -> bool:
    """A DER sequence built as a key or certificate is."""
    outer = _elements(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    parts = _nested(data, outer[0][1], outer[0][2])
    if not parts or len(parts) < 2:
        return False
    if parts[0][0] == _INTEGER:  # version first: private keys
        return all(t in (_INTEGER, 0x04, _SEQUENCE, 0xA0, 0xA1) for t, _, _ in parts)
    if parts[0][0] == _SEQUENCE:  # algorithm first: public keys; or a signed certificate
        inner = _elements(data, parts[0][1], parts[0][2])
        by_name = bool(inner) and inner[0][0] == _OBJECT_ID
        signed = len(parts) == 3 and parts[1][0] == _SEQUENCE
        return parts[-1][0] == 0x03 and (by_name or signed)
    return False


def _fields(data: bytes, at: int) -> list[bytes] | None:
    """Length-prefixed fields that fill the rest exactly."""
    found = []
    while at < len(data):
        if len(data) - at < 4:
            return None
        size = struct.unpack_from(">I", data, at)[0]
        at += 4
        if len(data) - at < size:
            return None
        found.append(data[at : at + size])
        at += size
    return found


def is_ssh_key(data: bytes) -> bool:
    if data.startswith(_SSH_MAGIC):
        at, sizes = len(_SSH_MAGIC), []
        for _ in range(3):  # cipher, key derivation, its options
            if len(data) - at < 4:
                return False
            sizes.append(struct.unpack_from(">I", data, at)[0])
            at += 4 + sizes[-1]
        if len(data) - at < 4 or not 1 <= struct.unpack_from(">I", data, at)[0] <= 64:
            return False
        keys = _fields(data, at + 4)
        return bool(keys) and len(keys) >= 2
    fields = _fields(data, 0)
    return bool(fields) and len(fields) >= 2 and fields[0].startswith(_SSH_NAMES)


def _is_key(data: bytes | None) -> bool:
    return data is not None and len(data) >= 24 and (is_der_key(data) or is_ssh_key(data))


def _object(part: str) -> dict | None:
    data = _unbase64(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    header, payload, _ = text.split(".")
    head = _object(header)
    return head is not None and isinstance(head.get("alg"), str) and _object(payload) is not None


def signed_tokens(text: str) -> list[tuple[int, int]]:
    """Starts and ends of signed tokens, none of which begins inside an earlier one.

    Every dot may end a header, so a dotted word right before a token hides nothing.
    """
    found, end = [], 0
    for m in _AFTER_HEADER.finditer(text):
        dot = start = m.start()
        while start > end and text[start - 1] in _URL_SAFE:
            start -= 1
        if dot - start >= SHORTEST_HEADER and is_signed_token(text[start : m.end(1)]):
            end = m.end(1)
            found.append((start, end))
    return found


def _holds_key(run: str) -> bool:
    """A run of base64 or hex digits that decodes to a key."""
    if _is_key(_unbase64(run)):
        return True
    return bool(_HEX_ONLY.fullmatch(run)) and _is_key(bytes.fromhex(run))


def wrapped_keys(text: str) -> list[tuple[int, int]]:
    """Starts and ends of keys that are wrapped over lines, with or without a short last line."""
    found = []
    for m in _WRAPPED.finditer(text):
        whole = "".join(m[1].split())
        if m[2] and _holds_key(whole + m[2]):
            found.append(m.span())
        elif _holds_key(whole):
            found.append((m.start(), m.start() + len(m[1].rstrip())))
    return found


def _begins_inside(start: int, spans: list[tuple[int, int]]) -> bool:
    """Whether one of the sorted, separate spans covers ``start``."""
    at = bisect_right(spans, start, key=lambda span: span[0])
    return at > 0 and start < spans[at - 1][1]


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start, then in the order of ``KINDS``."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [
            ("assign", m.start(), m.end())
            for m in _ASSIGN.finditer(text)
            if m.end(1) - m.start(1) >= SHORTEST_VALUE
        ]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("token", a, b) for a, b in signed_tokens(text)]
    keys = []
    if "-----BEGIN " in text:
        keys = [
            m.span() for m in _ARMOR.finditer(text) if _is_key(_unbase64(_LINE_END.sub("", m[2])))
        ]
    runs = list(_RUN.finditer(text))
    if runs:  # every long run of hex digits, and every wrapped key, begins in one
        found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
        armored = list(keys)
        keys += [s for s in wrapped_keys(text) if not _begins_inside(s[0], armored)]
    keys.sort()
    for m in runs:
        skip = 2 * m[0].startswith(("0x", "0X"))
        if not _begins_inside(m.start(), keys) and _holds_key(m[0][skip:]):
            found.append(("key", m.start() + skip, m.end()))
    found += [("key", a, b) for a, b in keys]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, found)``: the secrets of every whole text as kind, start and end.

    A null or empty text has none.  Rows are independent of each other, so there is no
    shuffle, and rows of one ``doc_id`` each give theirs.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(text.as_py() or "")]
                for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, _SPANS)], names=["doc_id", "found"]
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        look, "doc_id bigint, found array<struct<kind: string, start: bigint, end: bigint>>"
    )
