"""Secrets in text, confirmed by structure.

Three patterns report by their looks: assignments to telling names, access key
ids and long runs of hex digits.  Everything else is reported only when what it
decodes to has the structure of a secret:

* base64 (also cut into lines, also with a written-out ``\\n``) and hex that hold
  a DER private key: nested lengths that fit exactly, and the fields of an RSA
  (``rsa``; the modulus is the product of the primes), PKCS#8 (``pkcs8``, also
  encrypted) or elliptic curve key (``ec``);
* base64 that holds an OpenSSH private key (``openssh``): the magic bytes, then
  length-prefixed names, key blobs and the private part, to the end;
* signed tokens (``jwt``): a JSON header that names a signature algorithm, a JSON
  object, and a signature of that algorithm's size.

Candidates begin where a run of their alphabet begins.  Lengths are read by
decoding a few characters at the place where they stand, so a candidate that does
not nest costs a fixed number of steps and one that does is decoded once: a text
is read in time linear in its length.

Defined cases: null counts as empty; a text without secrets has empty lists; rows
that repeat, null ids and other columns change nothing.  Spans are code points of
the whole match, end exclusive; spans of different kinds may overlap.
"""

from __future__ import annotations

import binascii
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import ship
from paritas.llm.shingles import as_bytes

#: Kinds in the order in which spans that begin together are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "rsa", "pkcs8", "ec", "openssh", "jwt")

# All alphabets are ASCII, so patterns run over UTF-8 bytes; in bytes, case is ignored for A-Z only.
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(rb"[0-9a-f]{32,}")

#: Line breaks inside base64: real ones, perhaps indented, and written-out ones.
_BREAK = rb"(?:\r?\n[ \t]*|\\r\\n|\\n)"
# Lines after the first are taken up whole; a key begins with a SEQUENCE (M) or the magic of OpenSSH (b3Bl).
_BASE64 = re.compile(rb"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{16,}(?:" + _BREAK + rb"[A-Za-z0-9+/]+)*={0,2}")
_LINE = re.compile(_BREAK)
_HEX_RUN = re.compile(rb"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{30,}")
_TOKEN = re.compile(rb"(?<![\w-])e[w-z0-9_-][\w-]*\.e[w-z0-9_-][\w-]*\.[\w-]*(?![\w-])", re.A)

_OPENSSH = b"openssh-key-v1\0"
#: Sizes of signatures by algorithm, in bytes; None: as long as the key, at least 128.
_SIGNATURES = {
    "HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": None, "RS256": None, "RS384": None,
    "RS512": None, "PS256": None, "PS384": None, "PS512": None,
}

Read = Callable[[int, int], bytes]


def _from_base64(text: bytes, start: int) -> Read:
    """Reader of bytes at a place of what ``text`` from ``start`` on decodes to."""

    def read(at: int, n: int) -> bytes:
        first, last = at // 3 * 4, -(-(at + n) // 3) * 4
        piece = text[start + first : start + last]
        piece = piece[: len(piece) - (len(piece) % 4 == 1)]
        return binascii.a2b_base64(piece + b"=" * (-len(piece) % 4))[at % 3 : at % 3 + n]

    return read


def _from_hex(text: bytes) -> Read:
    return lambda at, n: bytes.fromhex(text[2 * at : 2 * (at + n) & ~1].decode())


# Key encodings


def _element(read: Read, at: int) -> tuple[int, int, int] | None:
    """``(tag, first content byte, end)`` of the DER element at a place; lengths must be the shortest spelling."""
    head = read(at, 6)
    if len(head) < 2:
        return None
    tag, size = head[0], head[1]
    if size < 0x80:
        return tag, at + 2, at + 2 + size
    width = size & 0x7F
    if not 1 <= width <= 4 or len(head) < 2 + width:
        return None
    size = int.from_bytes(head[2 : 2 + width], "big")
    if size < 0x80 or size < 1 << 8 * (width - 1):
        return None
    return tag, at + 2 + width, at + 2 + width + size


def _children(read: Read, start: int, end: int, most: int = 12) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``start`` to ``end`` exactly."""
    found = []
    while start < end:
        item = _element(read, start)
        if item is None or item[2] > end or len(found) == most:
            return None
        found.append(item)
        start = item[2]
    return found


def _number(read: Read, item: tuple[int, int, int]) -> int:
    return int.from_bytes(read(item[1], item[2] - item[1]), "big")


def _holds_key(read: Read, item: tuple[int, int, int]) -> bool:
    """An OCTET STRING of a private key: DER inside, or the bare bytes of a fixed size."""
    inner = _element(read, item[1])
    return item[2] - item[1] in (32, 56, 57, 64) or bool(inner and inner[0] in (0x02, 0x04, 0x30) and inner[2] == item[2])


def der_key(read: Read, available: int) -> tuple[str, int] | None:
    """``(kind, bytes)`` of the private key that begins at the first byte."""
    whole = _element(read, 0)
    if whole is None or whole[0] != 0x30 or whole[2] > available or whole[2] < 24:
        return None
    items = _children(read, whole[1], whole[2])
    if not items or len(items) < 2:
        return None
    tags = [i[0] for i in items]
    if tags[:2] == [0x30, 0x04] and len(tags) == 2:  # encrypted PKCS#8: algorithm, octets
        named = _children(read, items[0][1], items[0][2])
        oid = named and named[0][0] == 0x06 and read(named[0][1], named[0][2] - named[0][1])
        # 1.2.840.113549.1.5 and .12.1: password-based encryption
        return ("pkcs8", whole[2]) if oid and oid.startswith((b"\x2a\x86\x48\x86\xf7\x0d\x01\x05", b"\x2a\x86\x48\x86\xf7\x0d\x01\x0c\x01")) else None
    if tags[0] != 0x02 or items[0][2] - items[0][1] != 1:
        return None
    version = read(items[0][1], 1)[0]
    if version in (0, 1) and tags[1:3] == [0x30, 0x04] and set(tags[3:]) <= {0xA0, 0xA1, 0x81}:
        named = _children(read, items[1][1], items[1][2])
        return ("pkcs8", whole[2]) if named and named[0][0] == 0x06 and _holds_key(read, items[2]) else None
    if version == 1 and tags[1] == 0x04 and len(tags) > 2 and set(tags[2:]) <= {0xA0, 0xA1}:
        size, inner = items[1][2] - items[1][1], [_element(read, i[1]) for i in items[2:]]
        fits = all(e and e[2] == i[2] and e[0] == (0x06 if i[0] == 0xA0 else 0x03) for e, i in zip(inner, items[2:]))
        return ("ec", whole[2]) if 20 <= size <= 66 and fits else None
    if version in (0, 1) and len(items) >= 9 and set(tags[:9]) == {0x02}:
        sizes = [items[i][2] - items[i][1] for i in (1, 4, 5)]
        if version == 0 and not 0 <= sizes[1] + sizes[2] - sizes[0] <= 3:
            return None  # no product of two such numbers; they need not be read
        n, p, q = (_number(read, items[i]) for i in (1, 4, 5))
        return ("rsa", whole[2]) if n > 1 and (version == 1 or n == p * q) else None
    return None


def openssh_key(read: Read, available: int) -> int | None:
    """Bytes of the OpenSSH private key that begins at the first byte."""
    if read(0, len(_OPENSSH)) != _OPENSSH:
        return None
    at = len(_OPENSSH)

    def field() -> tuple[int, int] | None:
        nonlocal at
        size = read(at, 4)
        if len(size) < 4 or at + 4 + int.from_bytes(size, "big") > available:
            return None
        start = at + 4
        at = start + int.from_bytes(size, "big")
        return start, at

    names = [field(), field(), field()]  # cipher, key derivation and its options
    if None in names or not all(read(a, min(b - a, 64)).isascii() for a, b in names[:2]):
        return None
    count = int.from_bytes(read(at, 4), "big")
    at += 4
    if not 1 <= count <= 16 or any(field() is None for _ in range(count)):
        return None
    private = field()
    if private is None or private[1] - private[0] < 16:
        return None
    if read(*_slice(names[0])) == b"none":  # not encrypted: the check number stands twice
        check = read(private[0], 8)
        if check[:4] != check[4:]:
            return None
    return at


def _slice(bounds: tuple[int, int]) -> tuple[int, int]:
    return bounds[0], bounds[1] - bounds[0]


def _segment(text: bytes) -> bytes | None:
    """What an unpadded base64url segment decodes to."""
    if len(text) % 4 == 1:
        return None
    return binascii.a2b_base64(text.translate(bytes.maketrans(b"-_", b"+/")) + b"=" * (-len(text) % 4))


def _object(text: bytes) -> dict | None:
    try:
        found = json.loads((_segment(text) or b"").decode())
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def signed_token(text: bytes) -> bool:
    """Three segments: a header that names an algorithm, an object, a signature of its size."""
    head, body, signature = text.split(b".")
    header = _object(head)
    algorithm = header.get("alg") if header else None
    if not isinstance(algorithm, str) or algorithm not in _SIGNATURES or _object(body) is None:
        return False
    size, most = _SIGNATURES[algorithm], _segment(signature)
    if most is None:
        return False
    return len(most) == size if size else len(most) in (64, 114) if algorithm == "EdDSA" else len(most) >= 128


# Spans


def _base_spans(text: bytes) -> Iterator[tuple[int, int, int]]:
    for found in _ASSIGN.finditer(text):
        if found.end(1) - found.start(1) >= 8:
            yield found.start(), found.end(), 0
    for kind, pattern in ((1, _ACCESS), (2, _HEX)):
        for found in pattern.finditer(text):
            yield found.start(), found.end(), kind


def _keys_in_base64(text: bytes, start: int, end: int) -> Iterator[tuple[int, int, int]]:
    """Keys in one candidate: they begin where a line begins, end in the same candidate, and may follow each other."""
    places, pieces, at = [start], [], start  # where lines begin in the text
    for gap in _LINE.finditer(text, start, end):
        pieces.append(text[at : gap.start()])
        at = gap.end()
        places.append(at)
    pieces.append(text[at:end].rstrip(b"="))
    joined = b"".join(pieces)
    begins = np.cumsum([0, *map(len, pieces)]).tolist()
    free = 0  # characters up to here belong to a key that was found
    for k, first in enumerate(begins[:-1]):
        if first < free or joined[first : first + 1] not in (b"M", b"b"):
            continue
        read, available = _from_base64(joined, first), (len(joined) - first) * 3 // 4
        found = der_key(read, available)
        if found is None and (size := openssh_key(read, available)):
            found = "openssh", size
        if found is None:
            continue
        chars = -(-found[1] * 4 // 3)
        free = first + chars
        line = int(np.searchsorted(begins, free, "left")) - 1
        stop = places[line] + free - begins[line]
        # padding fills the last four characters; anything else there is not the end of the key
        if free < begins[line + 1]:
            free = first
            continue
        pad = -chars % 4
        if line == len(pieces) - 1 and text[stop : stop + pad] == b"=" * pad:
            stop += pad
        yield places[k], stop, KINDS.index(found[0])


def _confirmed_spans(text: bytes) -> Iterator[tuple[int, int, int]]:
    for found in _BASE64.finditer(text):
        yield from _keys_in_base64(text, *found.span())
    for found in _HEX_RUN.finditer(text):
        run = found.group()
        key = der_key(_from_hex(run), len(run) // 2)
        if key and 2 * key[1] == len(run):
            yield *found.span(), KINDS.index(key[0])
    for found in _TOKEN.finditer(text):
        if signed_token(found.group()):
            yield *found.span(), KINDS.index("jwt")


def spans(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, end, place in KINDS)`` in code points, by start, then kind, then end."""
    found = sorted({*_base_spans(text), *_confirmed_spans(text)})
    if not found:
        return []
    edges = sorted({e for s in found for e in s[:2]})
    data, at, count, points = np.frombuffer(text, np.uint8), 0, 0, {}
    for edge in edges:
        count += int(np.count_nonzero((data[at:edge] & 0xC0) != 0x80))
        at, points[edge] = edge, count
    return sorted(((points[a], points[b], kind) for a, b, kind in found), key=lambda s: (s[0], s[2], s[1]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = as_bytes(batch.column(1))
        rows = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, e, k in spans(data[a:b].tobytes())])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["id", "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, spans``: per row the ``kind``, ``start`` and ``end`` of every secret, by start, then kind as listed in ``KINDS``."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(_scan, f"id {kind}, spans array<struct<kind string, start bigint, end bigint>>").withColumnRenamed("id", id_col)


def secret_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every document."""
    found = find_secrets(docs)

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda span: span["kind"].isin(*kinds))

    def text(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])), ",")

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    digest = F.sha2(text(of(*BASE_KINDS)).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, text(F.col("spans")).alias("spans"))
