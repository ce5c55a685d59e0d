"""Secret scans: patterns, and structures that decoding confirms."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrid.llm.common import slices

#: Kinds in the order of reports. The first three are found by their pattern alone.
KINDS = ("assign", "access", "hex", "der_key", "ssh_key", "signed_token")
BASE = KINDS[:3]

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: As long a run from its first character on is what dropping shorter runs leaves.
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE, LEAST_ACCESS = 12, 18

#: Runs that are decoded whole. None starts within a longer run.
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}+={0,2}")
HEX_DATA = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}+(?![0-9A-Fa-f])")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[w-z0-9_-][A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,40})-----")
#: What a text holds that has anything of a kind; wider than the patterns, and asked of all texts of a batch.
HINTS = {
    "assign": r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": "AKIA[A-Z0-9]",
    "hex": "[0-9a-f]{16}",
    "coded": "[A-Za-z0-9+/_-]{40}|-----BEGIN ",
    "signed_token": r"e[w-z0-9_-][A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+\.",
}
#: Codings within each other that are followed.
DEEPEST = 3
#: Bytes of a signature by algorithm, for RSA the least.
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "ES256K": 64}
EDWARDS, RSA_KINDS, LEAST_RSA = (64, 114), {f"{kind}{bits}" for kind in ("RS", "PS") for bits in (256, 384, 512)}, 128
#: Object identifiers of password-based encryption, up to their last number.
ENCRYPTED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


# Key encodings


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the elements that fill ``data`` to its last byte; null if none do.

    Lengths are definite and as short as they can be, as the distinguished encoding asks.
    """
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or data[at] & 0x1F == 0x1F:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size > 0x7F:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data) or not data[at]:
                return None
            size = int.from_bytes(data[at: at + width], "big")
            at += width
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        found.append((tag, data[at: at + size]))
        at += size
    return found


def _tags(items: list[tuple[int, bytes]]) -> bytes:
    return bytes(tag for tag, _ in items)


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one private key: plain RSA, DSA or elliptic, wrapped, or wrapped and encrypted."""
    whole = elements(data)
    if not whole or len(whole) > 1 or whole[0][0] != 0x30:
        return False
    items = elements(whole[0][1])
    if not items or any(not content for _, content in items):
        return False
    tags, version = _tags(items), items[0][1]
    if tags[:3] == b"\x02\x30\x04" and version in (b"\0", b"\1"):
        algorithm = elements(items[1][1])
        inner = elements(items[2][1])
        return bool(algorithm and algorithm[0][0] == 6 and inner and len(inner) == 1) and set(tags[3:]) <= {0xA0, 0x81, 0xA1}
    if tags[:1] == b"\x02" and set(tags) == {2} and version == b"\0" and len(items) in (6, 9):
        return len(items[1][1]) >= 32
    if tags[:2] == b"\x02\x04" and version == b"\1" and 16 <= len(items[1][1]) <= 66:
        return set(tags[2:]) <= {0xA0, 0xA1}
    if tags == b"\x30\x04":
        algorithm = elements(items[0][1])
        return bool(algorithm and algorithm[0][0] == 6 and algorithm[0][1].startswith(ENCRYPTED))
    return False


SSH_MAGIC = b"openssh-key-v1\0"


def _strings(data: bytes, count: int) -> tuple[list[bytes], bytes] | None:
    """So many strings with their lengths before them, and the rest."""
    found = []
    for _ in range(count):
        size = int.from_bytes(data[:4], "big")
        if len(data) < 4 + size or len(data) < 4:
            return None
        found.append(data[4: 4 + size])
        data = data[4 + size:]
    return found, data


def is_ssh_key(data: bytes) -> bool:
    """Whether the bytes are private keys as OpenSSH stores them, every length fitting."""
    if not data.startswith(SSH_MAGIC):
        return False
    head = _strings(data[len(SSH_MAGIC):], 3)
    if head is None or len(head[1]) < 4:
        return False
    keys = int.from_bytes(head[1][:4], "big")
    if not 1 <= keys <= 64:
        return False
    tail = _strings(head[1][4:], keys + 1)
    if tail is None or tail[1]:
        return False
    *public, private = tail[0]
    if any(_strings(key, 1) is None for key in public):
        return False
    # Unencrypted keys begin with one number twice.
    return len(private) >= 8 and (head[0][0] != b"none" or private[:4] == private[4:8])


# Codings


def from_base64(text: str) -> bytes | None:
    """Bytes of either alphabet of base64, padding optional; null if it is none."""
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text.replace("-", "+").replace("_", "/") + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    data = from_base64(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    """Whether header and payload are objects and the signature is as long as the header's algorithm makes it."""
    header, payload, signature = text.split(".")
    head = _json_object(header)
    kind = head.get("alg") if head else None
    size = len(from_base64(signature) or b"")
    if not isinstance(kind, str) or _json_object(payload) is None:
        return False
    if kind == "EdDSA":
        return size in EDWARDS
    return size >= LEAST_RSA if kind in RSA_KINDS else size == SIGNATURES.get(kind)


def armoured(text: str, start: int) -> tuple[int, str | None]:
    """End of the armoured block that starts here, and the kind of key that its body is; -1 for no block."""
    label = ARMOUR.match(text, start)
    closing = f"-----END {label.group(1)}-----"
    following = text.find("-----BEGIN ", label.end())
    end = text.find(closing, label.end(), following if following >= 0 else len(text))
    if end < 0:
        return -1, None
    body = text[label.end(): end].replace("\\n", "\n").replace("\\r", "")
    lines = ["".join(line.split()) for line in body.split("\n")]
    data = from_base64("".join(line for line in lines if ":" not in line))
    return end + len(closing), key_kind(data, DEEPEST) if data else None


def key_kind(data: bytes, depth: int = 1) -> str | None:
    """Kind of the key that bytes hold, also where they are once more coded or armoured text."""
    if is_der_key(data):
        return "der_key"
    if is_ssh_key(data):
        return "ssh_key"
    if depth >= DEEPEST or not data.isascii():
        return None
    text = data.decode().strip()
    begin = ARMOUR.match(text)
    if begin:
        return armoured(text, 0)[1]
    for pattern, decode in ((HEX_DATA, bytes.fromhex), (BASE64, from_base64)):
        if pattern.fullmatch(text):
            inner = decode(text)
            kind = key_kind(inner, depth + 1) if inner else None
            if kind:
                return kind
    return None


def confirmed(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of key and token candidates that decoding confirms; none lies in another."""
    found = []
    for match in ARMOUR.finditer(text):
        end, kind = armoured(text, match.start())
        if kind:
            found.append((kind, match.start(), end))
    for pattern, decode in ((BASE64, from_base64), (HEX_DATA, bytes.fromhex)):
        for match in pattern.finditer(text):
            data = decode(match.group())
            kind = key_kind(data) if data else None
            if kind:
                found.append((kind, *match.span()))
    found += [("signed_token", *match.span()) for match in TOKEN.finditer(text) if is_signed_token(match.group())]
    kept, end = [], -1
    for span in sorted(found, key=lambda span: (span[1], -span[2])):
        if span[1] >= end:
            kept.append(span)
            end = span[2]
    return kept


def secrets_of(text: str | None, hints: frozenset[str] = frozenset(HINTS)) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points of all secrets of a whole text, by start and order of kinds."""
    if not text or not hints:
        return []
    found = []
    if "assign" in hints:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    if "access" in hints:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST_ACCESS]
    if "hex" in hints:
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "coded" in hints or "signed_token" in hints:
        found += confirmed(text)
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, overlapping ones as one, replaced by the kind of the first in brackets."""
    parts, end = [], 0
    for kind, start, stop in spans:
        if start >= end:
            parts += [text[end:start], f"[{kind}]"]
        end = max(end, stop)
    return "".join([*parts, text[end:]])


_SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in (part for whole in batches for part in slices(whole, 0)):
        texts = pc.fill_null(batch.column(0), "")
        hinted = {name: pc.match_substring_regex(texts, hint).to_pylist() for name, hint in HINTS.items()}
        spans, clean = [], []
        for at, any_hint in enumerate(zip(*hinted.values())):
            hints = frozenset(name for name, holds in zip(hinted, any_hint) if holds)
            text = texts[at].as_py() if hints else ""
            own = secrets_of(text, hints)
            spans.append([dict(zip(("kind", "start", "end"), span)) for span in own])
            clean.append(masked(text, own) if own else None)
        unchanged = batch.column(0).cast(pa.string())
        texts = pc.coalesce(pa.array(clean, pa.string()), unchanged)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(spans, kind), texts], names=[*batch.schema.names[1:], "secrets", "masked"]
        )


def with_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with ``secrets``, the spans (kind, start, end) of a whole text, and ``masked``, the text without them.

    Spans count code points, the end is exclusive, and they are sorted by start and then
    by the order of ``KINDS``. Kinds after the first three are candidates in base64,
    hex or armour that decode to a private key, or signed tokens. A null text has no spans
    and stays null when masked. Columns ``secrets`` and ``masked`` are replaced; an
    empty table stays empty.
    """
    keep = [name for name in docs.columns if name.lower() not in ("secrets", "masked")]
    fields = [docs.schema[name] for name in keep]
    schema = T.StructType([*fields, T.StructField("secrets", _SPANS), T.StructField("masked", T.StringType())])
    return docs.select(F.col("text").alias("_scan"), *keep).mapInArrow(_scan, schema)
