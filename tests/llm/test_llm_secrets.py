"""Secret scans against the patterns as they are stated, and against keys built by hand."""

import base64
import json
import random
import re

import pytest

from tillgrid.llm import secret_scan
from tillgrid.llm.secret_scan import confirmed, secrets_of

draw = random.Random(11)


def some(n):
    return bytes([draw.randrange(1, 128), *draw.randbytes(n - 1)]) if n else b""


def der(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else (lambda w: bytes([0x80 | len(w)]) + w)(n.to_bytes((n.bit_length() + 7) // 8, "big"))
    return bytes([tag]) + size + content


def number(n):
    return der(2, some(n))


def rsa():
    return der(0x30, der(2, b"\0") + number(128) + der(2, b"\1\0\1") + number(128) + b"".join(number(64) for _ in range(5)))


def wrapped(inner, oid="2a864886f70d010101"):
    return der(0x30, der(2, b"\0") + der(0x30, der(6, bytes.fromhex(oid)) + b"\5\0") + der(4, inner))


ED = wrapped(der(4, some(32)), "2b6570")
EC = der(0x30, der(2, b"\1") + der(4, some(32)) + der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))
ENCRYPTED = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")) + der(0x30, der(4, some(8)))) + der(4, some(160)))
DIGEST = der(0x30, der(0x30, der(6, bytes.fromhex("608648016503040201")) + b"\5\0") + der(4, some(32)))
PUBLIC = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d010101")) + b"\5\0") + der(3, b"\0" + some(140)))


def string(data):
    return len(data).to_bytes(4, "big") + data


def ssh(check=(b"abcd", b"abcd")):
    public = string(string(b"ssh-ed25519") + string(some(32)))
    private = check[0] + check[1] + string(b"ssh-ed25519") + string(some(32)) + string(some(64)) + string(b"me@here")
    return b"openssh-key-v1\0" + string(b"none") + string(b"none") + string(b"") + b"\0\0\0\1" + public + string(private)


def b64(data):
    return base64.b64encode(data).decode()


def url64(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def pem(data, label="PRIVATE KEY", line="\n", width=64):
    text = b64(data)
    return f"-----BEGIN {label}-----{line}" + line.join(text[i: i + width] for i in range(0, len(text), width)) + f"{line}-----END {label}-----"


def token(head={"alg": "HS256", "typ": "JWT"}, body={"sub": "1"}, size=32):
    return ".".join([url64(json.dumps(head).encode()), url64(json.dumps(body).encode()), url64(some(size))])


KEYS = [
    ("der_key", b64(rsa())), ("der_key", b64(ED)), ("der_key", url64(EC)), ("der_key", b64(ENCRYPTED)), ("der_key", wrapped(rsa()).hex()),
    ("der_key", EC.hex().upper()), ("der_key", pem(rsa(), "RSA PRIVATE KEY")), ("der_key", pem(ED)), ("der_key", pem(wrapped(rsa()), line="\\n")),
    ("der_key", pem(EC, "EC PRIVATE KEY", "\r\n")), ("ssh_key", pem(ssh(), "OPENSSH PRIVATE KEY", width=70)), ("ssh_key", b64(ssh())),
    ("der_key", b64(pem(rsa()).encode())), ("der_key", b64(ED.hex().encode())), ("der_key", pem(rsa(), width=4000)), ("signed_token", token()),
    ("signed_token", token({"typ": "JWT", "alg": "RS256"}, size=256)), ("signed_token", token({"alg": "EdDSA"}, size=64)),
]
CLEAN = [
    b64(DIGEST), b64(PUBLIC), b64(rsa()[:-1]), b64(rsa() + b"\0"), b64(some(300)), some(100).hex(), pem(PUBLIC, "PUBLIC KEY"), b64(ssh((b"abcd", b"abce"))),
    b64(ssh()[:-3]), token(size=31), token({"alg": "none"}, size=32), token({"typ": "JWT"}), token().replace(".", "x"), "-----BEGIN PRIVATE KEY-----\nhello\n",
    "M" * 5000, "e" * 3000, pem(rsa())[:-30] + pem(PUBLIC, "PUBLIC KEY"), token(["alg"]), "",
]


@pytest.mark.parametrize("kind, text", KEYS)
def test_structures_are_confirmed(kind, text):
    for before, after in (("", ""), ("see é 日 ", "\nend"), ('{"k": "', '"}'), ("a(", ") b")):
        whole = before + text + after
        assert confirmed(whole) == [(kind, len(before), len(before) + len(text))]


@pytest.mark.parametrize("text", CLEAN)
def test_other_data_is_left_alone(text):
    assert confirmed(f"x {text} y") == []


def test_der_lengths_must_nest():
    """No change of a length byte of the outer layers leaves a key."""
    key = wrapped(rsa())
    assert secret_scan.is_der_key(key)
    assert not any(secret_scan.is_der_key(key[:i] + bytes([key[i] ^ 1]) + key[i + 1:]) for i in (0, 1, 2, 3, 8, 23, 24))


BASE = {
    "assign": (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def base_of(text):
    found = []
    for kind, (pattern, group, least) in BASE.items():
        found += [(kind, *m.span()) for m in re.finditer(pattern, text or "", re.ASCII) if len(m.group(group)) >= least]
    return sorted(found, key=lambda s: (s[1], list(BASE).index(s[0])))


def odd_texts():
    parts = ["token", "TOKEN", "toKen", "api_key", "APIKEY", "secret", "ſecret", "password", ": ", "=", "=\"", "' = '", " : ", "x" * 11, "x" * 12, "AKIA", "AKIA" + "Z" * 13,
             "AKIA" + "9" * 14, "deadbeef" * 2, "deadbee" * 2, "ABCDEF" * 4, "é", "\n", " ", "日本", "A" * 41, "🙂"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 40))) for _ in range(400)]
    return [None, "", *texts, "token: token: abcdefghijkl", "AKIAAKIA" + "B" * 12, "password=" + "0a" * 40, *[f"secret={text}" for _, text in KEYS], *CLEAN]


def test_patterns_and_columns(spark):
    texts = odd_texts() + [" ".join(odd_texts()[2:]) * 5]
    rows = [(i, text, "s", 1, "c") for i, text in enumerate(texts)] + [(3, texts[3], "s", 1, "c")] * 2 + [(None, "token=abcdefghijklm", "s", 1, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets string, n_hex int, Masked string").repartition(3)
    made = secret_scan.with_secrets(docs)
    assert made.columns == ["doc_id", "text", "n_hex", "secrets", "masked"]
    found = made.collect()
    assert len(found) == len(rows)
    for row in found:
        spans = [tuple(span) for span in row["secrets"]]
        assert [span for span in spans if span[0] in BASE] == base_of(row["text"])
        assert spans == secrets_of(row["text"])
        if not spans:
            assert row["masked"] == row["text"]
        elif row["text"] is not None:
            covered = {i for _, a, b in spans for i in range(a, b)}
            assert re.sub(r"\[(%s)\]" % "|".join(secret_scan.KINDS), "", row["masked"]) == "".join(
                c for i, c in enumerate(row["text"]) if i not in covered
            )
    assert sum(span[0] == "der_key" for row in found for span in row["secrets"]) >= 13
    assert secret_scan.with_secrets(docs.limit(0)).count() == 0


def test_long_text():
    text = "password = hunter2hunter2 " + "word " * 200_000 + pem(rsa()) + " AKIA" + "Q" * 16
    assert [span[0] for span in secrets_of(text)] == ["assign", "der_key", "access"]
