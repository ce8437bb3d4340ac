"""Secrets in texts: patterns first, then candidates confirmed by the structure they decode to.

A run of base64 or hexadecimal digits is reported as a key only if its bytes parse: DER whose
nested lengths fill their parents exactly and end with the data, the length-prefixed strings
of a key in SSH wire format, or a signed token whose header is a JSON object with an algorithm.
The lengths with which a key begins tell where it ends; its lines may be indented, quoted, or
written with a literal backslash-n between them.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.functions import arrow_udf

# The base patterns, their kinds in order, and the least length of a match.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # the same as all longest runs of 16 or more
ASSIGN_CHARS = 12
ACCESS_CHARS = 18

KINDS = ("assign", "access", "hex", "jwt", "der", "ssh")

# Candidates for structure. A header is a JSON object, so a signed token begins with "ey" or "ew".
_SIGNED = re.compile(
    r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*"
)
# Between two lines of digits: line breaks, plain or as backslash-n, with indentation, quote
# marks, commas and signs that join or mark lines around them.
_GAP = re.compile(
    r"""(?:[\x20\t\r\n"'`,;>\#*|]|\\+(?:[nrt]|(?=[\x20\t\r\n"'`]))|(?<=["'`\x20])[+.](?=[\x20\t\r\n]))+"""
)
_LINE_BREAK = re.compile(r"[\r\n]|\\[nr]")
_PADDING = re.compile("={0,2}")


class _Coding:
    """Digits of an alphabet, and where a key can begin: after another character or a written
    line break, with the digits of a SEQUENCE of 22 bytes or more, of a short SSH name's length,
    or of the OpenSSH container's name."""

    def __init__(self, digits: str, heads: str, per_bytes: tuple[int, int], decode) -> None:
        first, rest = heads.split(" ")
        self.digits = re.compile(f"[{digits}]+")
        self.start = re.compile(rf"(?s)[{first}](?:(?<![{digits}].)|(?<=\\[nrt].))(?:{rest})")
        self.per_bytes = per_bytes
        self.decode = decode

    def digits_of(self, n: int) -> int:
        """How many digits n bytes have, without padding."""
        digits, size = self.per_bytes
        return -(-n * digits // size)


def _from_base64(digits: str) -> bytes | None:
    digits = digits.replace("-", "+").replace("_", "/").rstrip("=")
    try:
        return base64.b64decode(digits + "=" * (-len(digits) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


_BASE64_HEADS = "MAb (?<=M)(?:[B-H]|I[E-T])|(?<=A)AAA[A-J]|(?<=b)3BlbnNzaC1rZXktdjEA"
_HEX_HEADS = "036 (?<=3)0[1-8]|(?<=0)00000|(?<=6)[Ff]70656[Ee]"
_CODINGS = (
    _Coding("A-Za-z0-9+/", _BASE64_HEADS, (4, 3), _from_base64),
    _Coding("A-Za-z0-9_-", _BASE64_HEADS, (4, 3), _from_base64),
    _Coding("0-9A-Fa-f", _HEX_HEADS, (2, 1), bytes.fromhex),
)
# A public key of SSH has a few strings, with what an agent adds still below this.
_MOST_STRINGS = 16
# A DER structure deeper than this is no key.
_MAX_DEPTH = 32
# Names that begin a key in SSH wire format.
_SSH_NAMES = re.compile(rb"(sk-)?(ssh-(rsa|dss|ed25519)|ecdsa-sha2-nistp(256|384|521))(@openssh\.com)?")
_OPENSSH = b"openssh-key-v1\x00"
# How many strings a public key has at least, by how its name goes on after "ssh-" or "ecdsa-".
_SSH_STRINGS = {b"rsa": 3, b"dss": 5, b"ed2": 2, b"sha": 3}
# Object identifiers of digests: with an octet string they are a digest, not an encrypted key.
_DIGESTS = tuple(map(bytes.fromhex, ("6086480165030402", "2b0e03021a", "2a864886f70d02")))

RESULT = (
    "struct<n_assign: bigint, n_access: bigint, n_hex: bigint, base_sha256: string, "
    "spans: string>"
)
_TYPE = pa.struct(
    [
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def base_spans(text: str) -> list[Span]:
    """Matches of the three base patterns, by start and kind."""
    found = [
        (m.start(), 0, m.end())
        for m in _ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= ASSIGN_CHARS
    ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end())
            for m in _ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_CHARS
        ]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _der_values(data: bytes, begin: int, end: int, depth: int) -> list[tuple[int, int, int]] | None:
    """(tag, begin, end) of the values that fill data[begin:end] exactly; None if they do not.
    Sequences and sets are parsed to the bottom."""
    values = []
    while begin < end:
        if end - begin < 2 or depth > _MAX_DEPTH:
            return None
        tag, length, at = data[begin], data[begin + 1], begin + 2
        if length & 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > end or data[at] == 0:
                return None
            length, at = int.from_bytes(data[at : at + size], "big"), at + size
            if length < 0x80:
                return None  # the short form is required
        if at + length > end or tag & 0x1F == 0x1F:
            return None
        if tag & 0x20 and _der_values(data, at, at + length, depth + 1) is None:
            return None
        values.append((tag, at, at + length))
        begin = at + length
    return values


def is_der_key(data: bytes) -> bool:
    """One SEQUENCE that fills the data and looks like a key: a private key begins with a small
    version number, a public or an encrypted one with an algorithm's object identifier, then key
    material."""
    if len(data) < 24 or data[0] != 0x30:
        return False
    outer = _der_values(data, 0, len(data), 0)
    if outer is None or len(outer) != 1:
        return False
    inner = _der_values(data, outer[0][1], outer[0][2], 1)
    if inner is None or len(inner) < 2:
        return False
    tag, begin, end = inner[0]
    if tag == 0x02 and end - begin == 1 and data[begin] <= 3:
        return any(e - b >= 16 for t, b, e in inner[1:] if t in (0x02, 0x04))
    if tag == 0x30:
        parts = _der_values(data, begin, end, 2)
        if not parts or parts[0][0] != 0x06:
            return False
        size = inner[1][2] - inner[1][1]
        if inner[1][0] == 0x04:  # an encrypted private key
            is_digest = data[parts[0][1] : parts[0][2]].startswith(_DIGESTS)
            return len(inner) == 2 and size >= 16 and not is_digest
        return inner[1][0] == 0x03 and size >= 17
    return tag == 0x02 and len(inner) == 2 and end - begin >= 32 and inner[1][0] == 0x02


def _wire_strings(data: bytes) -> list[bytes] | None:
    """The strings of SSH wire format that fill the data exactly."""
    strings, at = [], 0
    while at < len(data):
        if at + 4 > len(data):
            return None
        length = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + length > len(data):
            return None
        strings.append(data[at : at + length])
        at += length
    return strings


def is_ssh_key(data: bytes) -> bool:
    """A public key of named strings, or the container of private keys with its nested lengths."""
    if data.startswith(_OPENSSH):
        rest, at = data[len(_OPENSSH) :], 0
        for _ in range(3):  # cipher, key derivation, its options
            length = int.from_bytes(rest[at : at + 4], "big")
            at += 4 + length
        if at + 4 > len(rest) or not 1 <= int.from_bytes(rest[at : at + 4], "big") <= 16:
            return False
        strings = _wire_strings(rest[at + 4 :])
        return bool(strings) and len(strings) == 1 + int.from_bytes(rest[at : at + 4], "big")
    strings = _wire_strings(data) if data[:3] == b"\x00\x00\x00" else None
    return (
        strings is not None
        and len(strings) >= 2
        and _SSH_NAMES.fullmatch(strings[0]) is not None
        and max(map(len, strings[1:])) >= 32
    )


def is_signed_token(token: str) -> bool:
    """Three parts of which the first is a JSON object that names an algorithm and the second
    decodes."""
    head, body, _ = token.split(".")
    decoded = _from_base64(head)
    if decoded is None or not decoded.lstrip().startswith(b"{") or _from_base64(body) is None:
        return False
    try:
        header = json.loads(decoded)
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def _kind_of(data: bytes | None) -> int | None:
    if not data:
        return None
    if data[0] == 0x30 and is_der_key(data):
        return 4
    if data[0] in (0x00, 0x6F) and is_ssh_key(data):
        return 5
    return None


class _Run:
    """The digits from ``start`` on, over the ends of lines, read as far as they are asked for."""

    def __init__(self, text: str, start: int, coding: _Coding) -> None:
        self.text, self.end, self.coding = text, start, coding
        self.parts: list[str] = []
        self.count = 0

    def first(self, n: int) -> bytes | None:
        """The first n bytes, if there are as many."""
        wanted = self.coding.digits_of(n)
        if wanted - self.count > len(self.text) - self.end:
            return None
        while self.count < wanted:
            at = self.end
            if self.parts:
                gap = _GAP.match(self.text, at)
                if gap is None or not _LINE_BREAK.search(gap.group()):
                    return None
                at = gap.end()
            line = self.coding.digits.match(self.text, at)
            if line is None:
                return None
            self.parts.append(line.group())
            self.count, self.end = self.count + len(line.group()), line.end()
        self.parts = ["".join(self.parts)]
        return self.coding.decode(self.parts[0][:wanted])

    def end_after(self, n: int) -> int | None:
        """Where the first n bytes end in the text, if a line's digits end with them."""
        if self.count != self.coding.digits_of(n):
            return None
        if self.coding.per_bytes == (2, 1):
            return self.end
        return _PADDING.match(self.text, self.end).end()


def _der_span(data: bytes, at: int) -> tuple[int, int]:
    """Where the value whose tag stands at ``at`` begins and ends, by its length."""
    length = data[at + 1]
    if length <= 0x80:
        return at + 2, at + 2 + length
    begin = at + 2 + (length & 0x7F)
    return begin, begin + int.from_bytes(data[at + 2 : begin], "big")


def _sizes(run: _Run) -> Iterator[int]:
    """After how many bytes a key may end, by the lengths that it begins with."""
    head = run.first(8)
    if head is None:
        return
    if head[0] == 0x30:
        at, end = _der_span(head, 0)
        if at >= len(head) or head[at] not in (0x02, 0x30):
            return
        for _ in range(4):  # the first values tell most look-alikes, before all is read
            data = run.first(min(at + 6, end)) if at + 2 <= end else None
            if data is None:
                return
            _, at = _der_span(data, at)
            if at >= end:
                break
        if at <= end:
            yield end
        return

    def length_at(at: int) -> int | None:
        data = run.first(at + 4)
        return None if data is None else int.from_bytes(data[at : at + 4], "big")

    if head == _OPENSSH[:8]:
        at = len(_OPENSSH)
        for _ in range(3):
            if (length := length_at(at)) is None:
                return
            at += 4 + length
        keys = length_at(at)
        if keys is None or not 1 <= keys <= _MOST_STRINGS:
            return
        at += 4
        for _ in range(1 + keys):
            if (length := length_at(at)) is None:
                return
            at += 4 + length
        yield at
        return
    at = 4 + (length_at(0) or 0)
    name = run.first(at)
    if name is None or not (found := _SSH_NAMES.fullmatch(name[4:])):
        return
    least = _SSH_STRINGS[found.group(2).split(b"-", 1)[1][:3]] + (found.group(1) is not None)
    for count in range(2, _MOST_STRINGS + 1):
        if (length := length_at(at)) is None:
            return
        at += 4 + length
        if count >= least:
            yield at


def _key_from(text: str, start: int, coding: _Coding) -> tuple[int, int] | None:
    """Kind and end of the key that begins at ``start``."""
    run = _Run(text, start, coding)
    for size in _sizes(run):
        data = run.first(size)
        if data is None:
            return None
        end = run.end_after(size)
        kind = None if end is None else _kind_of(data)
        if kind is not None:
            return kind, end
    return None


def confirmed_spans(text: str) -> list[Span]:
    """Spans of signed tokens and keys; a span is found once, whatever its alphabet. Where a key
    ends follows from the lengths it begins with, and the search goes on after that end."""
    found: set[Span] = set()
    for m in _SIGNED.finditer(text):
        if is_signed_token(m.group()):
            found.add((m.start(), 3, m.end()))
    for coding in _CODINGS:
        m = coding.start.search(text)
        while m is not None:
            key = _key_from(text, m.start(), coding)
            if key is not None:
                found.add((m.start(), *key))
            m = coding.start.search(text, m.start() + 1 if key is None else key[1])
    return sorted(found)


def written(spans: list[Span]) -> str:
    """kind:start:end of all spans, by start and kind."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(text: str) -> dict:
    base = base_spans(text)
    kinds = [kind for _, kind, _ in base]
    return {
        "n_assign": kinds.count(0),
        "n_access": kinds.count(1),
        "n_hex": kinds.count(2),
        "base_sha256": hashlib.sha256(written(base).encode()).hexdigest(),
        "spans": written(sorted(base + confirmed_spans(text))),
    }


def scan_secrets():
    """A function from a text column to counts of base matches, the digest of their list, and
    all spans.

    Positions count code points, the end is exclusive. A null or empty text has no span: counts
    of 0, the digest of nothing, an empty list. Texts are scanned whole.
    """

    @arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        return pa.array([_scan(text.as_py() or "") for text in column], _TYPE)

    return run


def _redacted(text: str, mark: str) -> str:
    parts, end = [], 0
    for start, _, stop in sorted(base_spans(text) + confirmed_spans(text)):
        if start >= end:
            parts += [text[end:start], mark]
        elif stop <= end:
            continue
        end = max(end, stop)
    return "".join([*parts, text[end:]]) if end else text


def redact_secrets(mark: str = "[SECRET]"):
    """A function from a text column to the text with every span replaced by ``mark``; spans
    that overlap are replaced once. Null stays null, other texts stay as they are."""

    @arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        texts = (text.as_py() for text in column)
        return pa.array([None if t is None else _redacted(t, mark) for t in texts], pa.string())

    return run
