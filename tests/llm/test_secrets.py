"""Secret spans: base patterns, structures that are confirmed, and look-alikes that are not."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from rosterlake.llm import queries, secret_scan


def either_case(word):
    return "".join(f"[{c}{c.upper()}]" for c in word)


def plain_base(text):
    names = [either_case(w) for w in ("password", "passwd", "secret", "token", "api")]
    names[-1] += "_?" + either_case("key")
    patterns = [
        rf"({'|'.join(names)})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        r"AKIA[A-Z0-9]+",
        r"[0-9a-f]+",
    ]
    spans = []
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text or ""):
            enough = (len(m.group(2)) >= 12) if kind == 0 else len(m.group()) >= (18 if kind == 1 else 16)
            if enough:
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


def der(tag, body):
    if len(body) < 128:
        return bytes([tag, len(body)]) + body
    size = len(body).to_bytes(4, "big").lstrip(b"\0")
    return bytes([tag, 0x80 | len(size)]) + size + body


def number(rng, size):
    return der(0x02, b"\x01" + rng.randbytes(size))


def private_key(rng):
    return der(0x30, der(0x02, b"\0") + b"".join(number(rng, n) for n in (128, 3, 128, 64, 64, 64, 64, 64)))


def public_key(rng):
    name = der(0x30, der(0x06, bytes.fromhex("2a864886f70d010101")) + b"\x05\0")
    return der(0x30, name + der(0x03, b"\0" + der(0x30, number(rng, 128) + number(rng, 3))))


def wire(*strings):
    return b"".join(len(s).to_bytes(4, "big") + s for s in strings)


def ssh_public(rng):
    return wire(b"ssh-ed25519", rng.randbytes(32))


def ssh_private(rng):
    inner = wire(b"none", b"none", b"") + (1).to_bytes(4, "big")
    return b"openssh-key-v1\0" + inner + wire(ssh_public(rng), rng.randbytes(144))


def token(header):
    def part(data):
        return base64.urlsafe_b64encode(data).decode().rstrip("=")

    return ".".join([part(json.dumps(header).encode()), part(b'{"sub":"1"}'), part(bytes(range(32)))])


def test_structures_are_confirmed():
    rng = random.Random(1)
    for make, kind in ((private_key, 4), (public_key, 4), (ssh_private, 5), (ssh_public, 5)):
        for _ in range(20):
            data = make(rng)
            plain = base64.b64encode(data).decode()
            lines = "\n".join(plain[k : k + 64] for k in range(0, len(plain), 64))
            for written in {plain, lines, data.hex(), data.hex().upper()}:
                text = f"before\n{written}\nAfter it"
                if written == plain and not plain.endswith("="):
                    text = f"before {written} after"
                assert (7, kind, 7 + len(written)) in secret_scan.confirmed_spans(text), written
    signed = token({"alg": "HS256", "typ": "JWT"})
    assert secret_scan.confirmed_spans(f"x {signed}, y") == [(2, 3, 2 + len(signed))]


def encoded(data, width=64):
    digits = base64.b64encode(data).decode().rstrip("=")
    return [digits[k : k + width] for k in range(0, len(digits), width)]


def spki(rng, size):
    """An RSA public key; 256 bytes of modulus make 294 bytes, which need no padding."""
    name = der(0x30, der(0x06, bytes.fromhex("2a864886f70d010101")) + b"\x05\0")
    return der(0x30, name + der(0x03, b"\0" + der(0x30, der(0x02, b"\0" + b"\xc1" + rng.randbytes(size - 1)) + der(0x02, b"\1\0\1"))))


def encrypted_key(rng):
    """PKCS#8 under PBES2."""
    name = der(0x30, der(0x06, bytes.fromhex("2a864886f70d01050d")) + der(0x30, der(0x04, rng.randbytes(8))))
    return der(0x30, name + der(0x04, rng.randbytes(1232)))


def test_keys_without_padding_one_per_line():
    rng = random.Random(3)
    for count in (1, 2, 3, 7):
        for make, kind in ((lambda r: spki(r, 256), 4), (ssh_public, 5)):
            datas = [make(rng) for _ in range(count)]
            assert kind == 5 or len(datas[0]) == 294
            for width in (10_000, 64):
                texts = ["\n".join(encoded(data, width)) for data in datas]
                text = "keys\n" + "\n".join([*texts, "One", "word", "each"])
                spans, at = [], 5
                for written in texts:
                    spans.append((at, kind, at + len(written)))
                    at += len(written) + 1
                assert secret_scan.confirmed_spans(text) == spans


@pytest.mark.parametrize(
    "join",
    ["\n", "\r\n", "\n    ", "\n\t", "\\n", "\\r\\n", "\\\\n", '",\n  "', '\\n"\n    "', "\\n' +\n  '", " \n> "],
)
def test_lines_of_a_key_in_other_files(join):
    rng = random.Random(4)
    for make, kind in ((private_key, 4), (encrypted_key, 4), (lambda r: spki(r, 256), 4), (ssh_private, 5)):
        written = join.join(encoded(make(rng)))
        for before, after in (("key: |" + join, join + "After"), ("-----BEGIN KEY-----" + join, join + "-----END KEY-----")):
            spans = secret_scan.confirmed_spans(before + written + after)
            assert spans == [(len(before), kind, len(before) + len(written))], join
            assert secret_scan._redacted(before + written + after, "#") == before + "#" + after


def test_encrypted_keys_and_digests():
    rng = random.Random(5)
    data = encrypted_key(rng)
    assert secret_scan.is_der_key(data)
    assert secret_scan.confirmed_spans(data.hex()) == [(0, 4, 2 * len(data))]
    sha256 = der(0x30, der(0x06, bytes.fromhex("608648016503040201")) + b"\x05\0")
    assert not secret_scan.is_der_key(der(0x30, sha256 + der(0x04, rng.randbytes(32))))


def test_look_alikes_are_not():
    rng = random.Random(2)
    broken = bytearray(private_key(rng))
    broken[5] ^= 0x40  # a nested length
    for data in (rng.randbytes(300), bytes(broken), private_key(rng)[:-1], private_key(rng) + b"\0", b"\x30\x80" * 90):
        assert secret_scan.confirmed_spans(base64.b64encode(data).decode()) == []
        assert secret_scan.confirmed_spans(data.hex()) == []
    assert secret_scan.confirmed_spans(token({"typ": "JWT"})) == []
    assert secret_scan.confirmed_spans("eyJhbGci.notbase64!.x " + "A" * 500 + " " + "word " * 50) == []


TEXTS = [
    None,
    "",
    "nothing here",
    'My Password = "abcdefghijkl" and api_key:short then apikey: 123456789012',
    "pa\u017f\u017fword=abcdefghijkl to\u212aen=abcdefghijkl",
    "AKIA" + "A" * 14 + " AKIAshort " + "0123456789abcdef" * 2 + "\u00e9" + "f" * 15,
    "token=token=token=abcdefghijklmnop",
    "secret: " + token({"alg": "none"}),
    "x" * 100_000 + " secret=0123456789abcdef",
]


def test_columns(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, TEXTS[3])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("x"))
    found = frame.select("text", secret_scan.scan_secrets()("text").alias("f")).collect()
    assert len(found) == len(rows)
    for r in found:
        base = plain_base(r.text)
        kinds = [k for _, k, _ in base]
        assert [r.f.n_assign, r.f.n_access, r.f.n_hex] == [kinds.count(k) for k in range(3)]
        written = secret_scan.written(base)
        assert r.f.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(filter(None, written.split(","))) <= set(r.f.spans.split(","))


def test_given_texts(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op9_secret_structure(spark, folder).collect()
    assert len(found) == len(texts) and sum(r.n_assign + r.n_access + r.n_hex for r in found) > 0
    for r in found:
        written = secret_scan.written(plain_base(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()


def test_redaction(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    found = [r.t for r in frame.select(secret_scan.redact_secrets("#")("text").alias("t")).collect()]
    assert found[:3] == TEXTS[:3]
    assert found[3] == 'My #" and api_key:short then #'
    for text in filter(None, found):
        assert not secret_scan.base_spans(text) and not secret_scan.confirmed_spans(text)


@pytest.mark.parametrize("depth", [5, 200])
def test_deep_nesting_ends(depth):
    data = b""
    for _ in range(depth):
        data = der(0x30, data)
    assert not secret_scan.is_der_key(data)
