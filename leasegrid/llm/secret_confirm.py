"""Secret scan with structural confirmation.

Assignments, access keys and long hex runs are found by pattern. Beyond them,
base64 and hex candidates are decoded and reported only if they parse: the DER
forms of private keys (RSA, DSA, EC, PKCS#8, encrypted PKCS#8) by version,
algorithm, number and order of their items, the nested lengths of OpenSSH
private keys, and signed tokens whose header and payload are JSON with an
algorithm. Public keys, certificates and signatures are no secrets.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE = 12
KINDS = ("assign", "access", "hex", "jwt", "key64", "keyhex")

JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,60})-----([A-Za-z0-9+/=\s]++)-----END \1-----")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")


def unbase64(text: str) -> bytes | None:
    """Bytes of standard or URL base64 without blanks, with or without padding; None if it is none."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER items that fill ``data`` exactly; None if a length does not fit."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at:at + n], "big"), at + n
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at:at + size]))
        at += size
    return items


# Tags of DER items.
INTEGER, BITS, OCTETS, OBJECT, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def _sequence(data: bytes) -> list[tuple[int, bytes]] | None:
    """Items of the one sequence that ``data`` is."""
    outer = der_items(data)
    return der_items(outer[0][1]) if outer and len(outer) == 1 and outer[0][0] == SEQUENCE else None


def _is_algorithm(content: bytes) -> bool:
    items = der_items(content)
    return bool(items) and len(items) <= 2 and items[0][0] == OBJECT and len(items[0][1]) >= 3


def is_der_key(data: bytes) -> bool:
    """Private key in one of its DER forms, which must fill ``data``."""
    items = _sequence(data)
    if not items or len(items) < 2:
        return False
    tags = [t for t, _ in items]
    if tags == [SEQUENCE, OCTETS]:  # encrypted PKCS#8
        return _is_algorithm(items[0][1]) and len(items[1][1]) >= 16
    if tags[0] != INTEGER or len(items[0][1]) != 1 or items[0][1][0] > 1:
        return False
    if tags[1:3] == [SEQUENCE, OCTETS]:  # PKCS#8: attributes and a public key may follow
        return _is_algorithm(items[1][1]) and len(items[2][1]) >= 16 and all(t in (0xA0, 0xA1, 0x81) for t in tags[3:])
    if tags[1] == OCTETS:  # EC: curve and public key may follow
        return items[0][1][0] == 1 and 16 <= len(items[1][1]) <= 80 and all(t in (0xA0, 0xA1) for t in tags[2:])
    numbers = [len(c) for t, c in items[1:] if t == INTEGER]
    if len(numbers) == len(items) - 1 and len(items) == 6:  # DSA: p, q, g, public and private number
        return numbers[0] >= 64 and numbers[1] >= 20
    # RSA: modulus, two exponents, two primes, two more exponents and a coefficient; more primes may follow
    return len(numbers) >= 8 and tags[:9] == [INTEGER] * 9 and numbers[0] >= 32 and numbers[1] <= 8 and numbers[0] >= numbers[3] > 0


def _field(data: bytes, at: int) -> tuple[bytes, int] | None:
    """A length-prefixed field and where the next one begins."""
    if at + 4 > len(data):
        return None
    end = at + 4 + int.from_bytes(data[at:at + 4], "big")
    return (data[at + 4:end], end) if end <= len(data) else None


def is_ssh_key(data: bytes) -> bool:
    """OpenSSH private key: cipher, key derivation, public keys and private part, whose lengths fill it exactly."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, fields = len(magic), []
    for _ in range(3):
        if (found := _field(data, at)) is None:
            return False
        fields.append(found[0])
        at = found[1]
    keys, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not re.fullmatch(rb"[a-z0-9@.-]+", fields[0]) or not 1 <= keys <= 64:
        return False
    for _ in range(keys):
        found = _field(data, at)
        name = found and _field(found[0], 0)
        if not name or not re.fullmatch(rb"[a-z0-9@.-]+", name[0]):
            return False
        at = found[1]
    found = _field(data, at)
    if found is None or found[1] != len(data) or len(found[0]) < 16:
        return False
    # an unencrypted part begins with one check number twice
    return fields[0] != b"none" or found[0][:4] == found[0][4:8]


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_ssh_key(data))


def is_signed_token(token: str) -> bool:
    """Header and payload are JSON objects, the header names an algorithm; only alg none may lack a signature."""
    head, body, sign = token.split(".")
    try:
        parts = [json.loads(unbase64(x) or b"") for x in (head, body)]
    except (ValueError, RecursionError):
        return False
    if not all(isinstance(p, dict) for p in parts) or not isinstance(parts[0].get("alg"), str):
        return False
    return parts[0]["alg"].lower() == "none" or bool(sign and unbase64(sign))


def find_secrets(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and confirmed spans (kind, start, end) of one whole text, in code points; null counts as empty."""
    text = text or ""
    base = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    base += [("access", *m.span()) for m in ACCESS.finditer(text)]
    base += [("hex", *m.span()) for m in HEX.finditer(text)]
    more = []
    if "eyJ" in text:
        more += [("jwt", *m.span()) for m in JWT.finditer(text) if is_signed_token(m[0])]
    for m in PEM.finditer(text) if "-----BEGIN " in text else ():
        if "KEY" in m[1] and is_key(unbase64(re.sub(r"\s+", "", m[2]))):
            more.append(("key64", *m.span(2)))
    held = sorted((a, b) for _, a, b in more)
    for m in BASE64.finditer(text):
        before = bisect.bisect_right(held, (m.start(), len(text)))
        if not (before and m.start() < held[before - 1][1]) and is_key(unbase64(m[0])):
            more.append(("key64", *m.span()))
    more += [("keyhex", *m.span()) for m in HEX_KEY.finditer(text) if is_key(bytes.fromhex(m[0]))]
    rank = {k: i for i, k in enumerate(KINDS)}

    def place(s: tuple[str, int, int]) -> tuple[int, int, int]:
        return s[1], rank[s[0]], s[2]

    return sorted(base, key=place), sorted(more, key=place)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, counts per kind, ``base_sha256`` and ``spans`` (kind:start:end, comma-joined).

    Spans are ordered by start, then kind. Null and empty texts have no span
    (empty string, hash of it). Repeated rows are scanned alike; further columns
    are ignored; texts are read whole, one at a time.
    """
    names = [f"n_{k}" for k in KINDS]

    @F.pandas_udf(", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                base, more = find_secrets(t)
                every = sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
                count = dict.fromkeys(KINDS, 0)
                for k, _, _ in every:
                    count[k] += 1
                rows.append((*count.values(), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            yield pd.DataFrame(rows, columns=[*names, "base_sha256", "spans"])

    return docs.select(F.col(id_col).alias("doc_id"), scanned(F.col(text_col)).alias("s")).select("doc_id", "s.*")
