"""Secret scans: pattern matches, and candidates confirmed by their decoded structure.

Base kinds are plain patterns: ``assign`` (a keyword given a value), ``access`` (access
key ids) and ``hex`` (long hexadecimal runs). The structural kinds are reported only when
decoding confirms them: ``jwt`` needs a header that decodes to a JSON object naming an
algorithm and a payload that is a JSON object; ``key`` needs base64 or hexadecimal text
(an armoured block or a bare run) that decodes to a private key, either a DER encoding
whose nested lengths add up or an OpenSSH key whose length-prefixed fields do.

Null and empty texts have no spans. Rows are independent, so repeated rows give repeated
results; only the named columns are read. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.stored import on_workers
from tripdemand.llm.text_arrays import chunks, strings

#: All kinds, in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "jwt", "key")
BASE_KINDS = KINDS[:3]

ASSIGN = re.compile(r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
WORDS = ("passw", "secret", "token", "api")  # one of them is in every assignment, in lower case
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Every access id, hexadecimal run and encoded key without armour holds such a run.
LONG = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")
#: Every signed token begins so.
TOKEN_START = re.compile(r"ey[A-Za-z0-9_-]{8,}\.")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])ey[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s]|\\+[nrt])+)-----END \1-----")
#: What armoured text is broken by: white space, in strings of source text or JSON escaped.
BREAKS = re.compile(r"\\+[nrt]|\s+")
RUN = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
CHUNK_BYTES = 8 << 20

INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, value) items that fill ``data`` exactly, or None if their lengths do not add up."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at : at + width], "big")
            at += width
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one DER private key: RSA, DSA, EC, or PKCS 8, plain or encrypted."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    items = der_items(outer[0][1])
    if not items:
        return False
    tags = [t for t, _ in items]
    if tags[0] == INTEGER and len(items[0][1]) == 1 and items[0][1][0] <= 1:
        if len(tags) >= 6 and all(t == INTEGER for t in tags[:6]):
            return True
        if tags[1:3] == [SEQUENCE, OCTETS]:
            algorithm = der_items(items[1][1])
            return bool(algorithm) and algorithm[0][0] == OID
        return len(tags) >= 2 and tags[1] == OCTETS and len(items[1][1]) >= 16
    if tags == [SEQUENCE, OCTETS]:
        algorithm = der_items(items[0][1])
        return bool(algorithm) and [t for t, _ in algorithm] == [OID, SEQUENCE] and len(items[1][1]) % 8 == 0
    return False


def is_openssh_key(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH private key whose length-prefixed fields fit."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        value = data[at + 4 : at + 4 + size]
        at += 4 + size
        return value if at <= len(data) and len(value) == size else None

    if any(field() is None for _ in range(3)) or at + 4 > len(data):  # cipher, derivation, its options
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    return 1 <= keys <= 64 and all(field() is not None for _ in range(keys + 1))


def unbase64(text: str) -> bytes | None:
    """The bytes of standard or URL-safe base64, padded or not; None if it is neither."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_key(text: str) -> bool:
    """Whether encoded text is a private key, read as hexadecimal or base64."""
    tries = [unbase64(text)]
    if len(text) % 2 == 0 and re.fullmatch(r"[0-9a-fA-F]+", text):
        tries.append(bytes.fromhex(text))
    return any(d is not None and (is_der_key(d) or is_openssh_key(d)) for d in tries)


def is_signed_token(text: str) -> bool:
    """Whether the first part decodes to a JSON object with an algorithm, and the second to a JSON object."""
    found = []
    for part in text.split(".")[:2]:
        try:
            found.append(json.loads((unbase64(part) or b"").decode()))
        except (UnicodeDecodeError, ValueError, RecursionError):
            return False
    return all(isinstance(x, dict) for x in found) and isinstance(found[0].get("alg"), str)


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a whole text, by start, then kind, then end."""
    if not text:
        return []
    spans = []
    low = text.lower()
    if any(w in low for w in WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if TOKEN_START.search(text):
        spans += [("jwt", *m.span()) for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    armoured = [m for m in ARMOUR.finditer(text) if is_key(BREAKS.sub("", m[2]))] if "PRIVATE KEY-----" in text else []
    spans += [("key", *m.span()) for m in armoured]
    if LONG.search(text):
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
        spans += [("hex", *m.span()) for m in HEX_LONG.finditer(text)]
        spans += [("key", *m.span()) for m in RUN.finditer(text) if not any(a.start() < m.end() and m.start() < a.end() for a in armoured) and is_key(m[0])]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str | None, spans: list[tuple[str, int, int]], mark: str) -> str | None:
    """The text with every stretch that spans cover replaced by one mark."""
    if not spans:
        return text
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id column, n_<kind> (long) of each base kind, base_sha256 (SHA-256 of
    the base spans as ``kind:start:end``, comma-joined), spans (all of them, joined likewise), and
    n_<kind> of the kinds that are confirmed by structure."""

    on_workers(docs.sparkSession)
    more = [k for k in KINDS if k not in BASE_KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK_BYTES):
            found = [find_secrets(t) for t in strings(batch.column("text"))]
            counts = {k: pa.array([sum(s[0] == k for s in f) for f in found], pa.int64()) for k in KINDS}
            base = [hashlib.sha256(listed([s for s in f if s[0] in BASE_KINDS]).encode()).hexdigest() for f in found]
            cols = [batch.column("id"), *(counts[k] for k in BASE_KINDS), pa.array(base), pa.array([listed(f) for f in found]), *(counts[k] for k in more)]
            yield pa.RecordBatch.from_arrays(cols, ["id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", *(f"n_{k}" for k in more)])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {source.schema['id'].dataType.simpleString()}, {''.join(f'n_{k} long, ' for k in BASE_KINDS)}base_sha256 string, spans string{''.join(f', n_{k} long' for k in more)}"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every span of their texts replaced by a mark; all columns stay."""

    on_workers(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([redacted(t, find_secrets(t), mark) for t in texts], dtype=object)

    return docs.withColumn(text_col, clean(F.col(text_col)))
