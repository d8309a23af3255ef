"""Secrets in texts, confirmed by their structure.

Base patterns find assignments, access keys and hex runs. Beyond them, runs that may be base64 or hex are decoded and
reported only if what they hold is well formed: a key encoding whose nested lengths fill it exactly, a signed token
whose header names an algorithm, or a text that itself holds a secret.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import in_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: In the order in which spans with one start are listed; the first three are the base kinds.
KINDS = ["assign", "access", "hex", "private_key", "signed_token", "encoded"]
BASE = KINDS[:3]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_HINTS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")
#: Runs from the length of the shortest base secret on: an assignment of 12 characters (token=abcdef).
_ANY_HEX = re.compile("(?<![0-9A-Fa-f])[0-9A-Fa-f]{24,}")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:(?!-----).){16,}?)-----END \1-----", re.S)
#: Line breaks and slashes as JSON and .env files escape them, and continued lines.
_ESCAPED = re.compile(r"\\+[nrt]?")
_DEK = re.compile(r"[A-Z0-9-]+,((?:[0-9A-Fa-f]{2})+)")
_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
#: Signature bytes by algorithm; 0 where they vary.
_SIGNATURE = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64, "RS256": 0, "RS384": 0, "RS512": 0, "PS256": 0, "PS384": 0, "PS512": 0}
_OPENSSH = b"openssh-key-v1\0"
#: Tags of the basic encoding rules that key files use.
_INTEGER, _OCTETS, _SEQUENCE = 0x02, 0x04, 0x30
_DEEPEST = 16
#: Encodings inside one another that are followed.
_LAYERS = 4


def decode_base64(run: str) -> bytes | None:
    """The bytes of a run in either alphabet, with or without padding."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, from, to) of the values that fill data[start:end] exactly, or None."""
    found = []
    while start < end:
        if end - start < 2:
            return None
        tag, n = data[start], data[start + 1]
        start += 2
        if n >= 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or start + k > end:
                return None
            n = int.from_bytes(data[start : start + k], "big")
            if n < 0x80 or data[start] == 0:  # lengths have one shortest form
                return None
            start += k
        if n > end - start:
            return None
        found.append((tag, start, start + n))
        start += n
    return found


def _well_nested(data: bytes, start: int, end: int, depth: int = 0) -> bool:
    inner = _elements(data, start, end)
    if inner is None or depth > _DEEPEST:
        return False
    return all(_well_nested(data, a, b, depth + 1) for tag, a, b in inner if tag & 0x20)


def is_key_encoding(data: bytes) -> bool:
    """A private key: one sequence that holds all bytes, a small version number first, then key material."""
    if data.startswith(_OPENSSH):
        return _is_openssh(data)
    if len(data) < 32 or data[0] != _SEQUENCE:
        return False
    outer = _elements(data, 0, len(data))
    if outer is None or len(outer) != 1:
        return False
    _, a, b = outer[0]
    inner = _elements(data, a, b)
    if inner is None or len(inner) < 2 or inner[0][0] != _INTEGER or data[inner[0][1] : inner[0][2]] not in (b"\0", b"\1"):
        return False
    material = [tag for tag, x, y in inner[1:] if tag in (_INTEGER, _OCTETS) and y - x >= 16]
    return bool(material) and _well_nested(data, a, b)


def _is_openssh(data: bytes) -> bool:
    """Cipher, derivation, its options, a count of keys, then as many public keys and one private part."""

    def field(at: int) -> int | None:
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at if at <= len(data) else None

    at: int | None = len(_OPENSSH)
    for _ in range(3):
        at = field(at)
        if at is None:
            return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 64:
        return False
    for _ in range(keys + 1):
        at = field(at)
        if at is None:
            return False
    return at == len(data)


def _json_object(data: bytes | None) -> dict | None:
    try:
        found = json.loads(data.decode("utf-8")) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """The header names a signing algorithm, the payload is an object, the signature is as long as it must be."""
    alg = (_json_object(decode_base64(header)) or {}).get("alg")
    if not isinstance(alg, str) or _json_object(decode_base64(payload)) is None:
        return False
    if alg.lower() == "none":
        return not signature
    signed = decode_base64(signature) if signature else None
    if signed is None or alg not in _SIGNATURE:
        return False
    return len(signed) == _SIGNATURE[alg] if _SIGNATURE[alg] else len(signed) >= 128


def _holds_secret(data: bytes, layers: int) -> bool:
    """A decoded text that itself has a secret of any kind."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    if not text.replace("\n", "").replace("\r", "").replace("\t", "").isprintable():
        return False
    return bool(spans(text, layers))


def _is_armoured_key(label: str, inner: str) -> bool:
    """What stands between the marks is a key, or encrypted as the label or the headers say."""
    lines = _ESCAPED.sub("\n", inner).split("\n")
    headers = {k.strip(): v.strip() for k, colon, v in (x.partition(":") for x in lines) if colon}
    data = decode_base64("".join("".join(x for x in lines if ":" not in x).split()))
    if not data:
        return False
    if dek := _DEK.fullmatch(headers.get("DEK-Info", "")):  # the vector is as long as a block of the cipher
        return len(data) >= 32 and len(data) % (len(dek[1]) // 2) == 0
    return is_key_encoding(data) or "ENCRYPTED" in label and _well_nested(data, 0, len(data))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    lower = text.lower()
    if any(h in lower for h in _HINTS):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    return found + [(*m.span(), "hex") for m in _HEX.finditer(text)]


def spans(text: str | None, layers: int = _LAYERS) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets, in code points, by start and then by kind as listed.

    Encoded texts are searched in the same way, ``layers`` deep.
    """
    if not text:
        return []
    found = base_spans(text)
    if "-----BEGIN " in text:
        found += [(*m.span(), "private_key") for m in _ARMOUR.finditer(text) if _is_armoured_key(*m.groups())]
    found += [(*m.span(), "signed_token") for m in _SIGNED.finditer(text) if is_signed_token(*m.groups())]
    armoured = [s for s in found if s[2] == "private_key"]
    for pattern, decode in ((_BASE64, decode_base64), (_ANY_HEX, lambda run: bytes.fromhex(run[: len(run) // 2 * 2]))):
        for m in pattern.finditer(text):
            if any(a <= m.start() < b for a, b, _ in armoured):
                continue
            data = decode(m.group())
            if data is None:
                continue
            if is_key_encoding(data):
                found.append((*m.span(), "private_key"))
            elif layers and _holds_secret(data, layers - 1):
                found.append((*m.span(), "encoded"))
    return sorted(set(found), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _scan(batches):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in in_slices(batches):
        made = [[{"kind": k, "start": a, "end": b} for a, b, k in spans(t)] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, kind)], ["row", "spans"])


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` as ``row`` and ``spans``: array of (kind, start, end), code points, end exclusive.

    Null and empty texts have no spans. Rows are looked at one by one, so null or repeated ids do not matter. Each text
    is read whole; its length bounds the memory of a task.
    """
    rest = [c for c in docs.columns if c != text_col]
    given = docs.select(F.struct(*rest).alias("row"), F.col(f"`{text_col}`").alias("text"))
    kinds = f"row {given.schema['row'].dataType.simpleString()}, spans array<struct<kind:string,start:int,end:int>>"
    return given.mapInArrow(_scan, kinds)


def listed(spans_col: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans_col, one), ",")
