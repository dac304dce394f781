"""Texts of megabytes, and texts that share an id."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import time

import pytest

from conftest import SF_CHECK
from loyalpulse.llm import queries as registered
from loyalpulse.llm import minhash, secrets_scan


def part(value):
    return base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")


TOKEN = f"{part({'alg': 'HS256'})}.{part({'sub': 'me'})}.c2lnbmF0dXJl"
DER = bytes([0x30, 126, 2, 1, 0, 0x30, 5, 6, 3, 43, 101, 112, 4, 114]) + bytes(range(114))
KEY = base64.b64encode(DER).decode()


def of_kind(text, kind):
    return [text[a:b] for k, a, b in secrets_scan.find_secrets(text) if k == kind]


@pytest.mark.parametrize(
    "text",
    [
        "ey. " + "n" * 1_000_000,
        "ey." + "n" * 1_000_000 + ".",
        "a." * 500_000,
        "abcdefgh.abcd" * 80_000,
        "-----BEGIN A KEY-----" * 50_000,
        "-----BEGIN A KEY-----" + "A" * 1_000_000,
        ("A" * 40 + "\n") * 25_000,
        ("f0" * 20 + "\n") * 25_000,
        "password" + " " * 1_000_000,
        "0x" + "30" * 500_000,
    ],
    ids=lambda text: text[:24].strip(),
)
def test_scan_takes_time_in_proportion_to_the_text(text):
    start = time.process_time()
    secrets_scan.find_secrets(text)
    assert time.process_time() - start < 4


def test_encoded_secrets_in_other_dress():
    assert of_kind(f"settings.production.{TOKEN} x", "token") == [TOKEN]
    pretty = base64.urlsafe_b64encode(b'{\n  "alg": "none"\n}').decode().rstrip("=")
    assert not pretty.startswith("ey")
    assert of_kind(f"{pretty}.{part({})}.", "token") == [f"{pretty}.{part({})}."]
    assert of_kind(f"0x{DER.hex()}", "key") == [DER.hex()]
    lines = [KEY[i : i + 64] for i in range(0, len(KEY), 64)]
    wrapped = "\n".join(lines)
    assert of_kind(f"key:\n{wrapped}\nend", "key") == [wrapped]
    even = "\n".join(DER.hex()[i : i + 64] for i in range(0, 2 * len(DER), 64))
    assert of_kind(f"{even}\nword", "key") == [even]
    escaped = "-----BEGIN PRIVATE KEY-----\\n" + "\\n".join(lines) + "\\n-----END PRIVATE KEY-----"
    assert of_kind(json.dumps({"k": 1}) + escaped, "key") == [escaped]
    assert of_kind("\n".join(lines[:-1]), "key") == []


def test_base_secrets_of_a_table_by_plain_patterns(spark):
    value = "password|passwd|secret|token|api_?key"
    value = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in value)
    assign = re.compile(f"({value})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")

    def by_hand(text):
        found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
        for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
            found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
        names = ("assign", "access", "hex")
        spans = ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in sorted(found))
        counts = [sum(row[1] == kind for row in found) for kind in range(3)]
        return (*counts, hashlib.sha256(spans.encode()).hexdigest())

    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()
    got = registered.QUERIES["op3_secret_scan"](spark, SF_CHECK).collect()
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got} == {
        r.doc_id: by_hand(r.text or "") for r in docs
    }


ONE = " ".join(f"one{i}" for i in range(40))
TWO = " ".join(f"two{i}" for i in range(40))
THREE = " ".join(f"three{i}" for i in range(40))
SHARED = [
    (1, ONE), (1, TWO), (2, f"{ONE} tail"), (3, f"{TWO} tail"), (4, THREE), (5, None), (5, THREE[5:]),
    (6, TWO), (7, "alone"), (7, "alone"), (None, ONE),
]


@pytest.mark.parametrize("turn", [1, -1])
def test_near_copies_of_texts_that_share_an_id(spark, turn):
    docs = spark.createDataFrame(SHARED[::turn], "doc_id bigint, text string").repartition(3)
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == {
        (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 4, False), (6, 1, False),
        (7, 7, True), (None, None, True),
    }
    assert minhash.near_duplicates(docs).count() == len(SHARED)
    kept = {tuple(r) for r in minhash.without_near_duplicates(docs).collect()}
    assert kept == {(1, ONE), (1, TWO), (4, THREE), (5, None), (7, "alone"), (None, ONE)}


def test_an_id_with_a_third_of_all_rows(spark):
    rows = [(9, f"{ONE} {i} {i * i}" if i % 2 else f"text{i} " * 9) for i in range(200)]
    rows += [(100 + i, f"{TWO} x{i}" if i % 3 else f"word{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = minhash.near_duplicates(docs)
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {
        (i, i if i == 9 or (i - 100) % 3 == 0 else 101) for i, _ in rows
    }
    assert minhash.without_near_duplicates(docs).filter("doc_id = 9").count() == 1 + 100
