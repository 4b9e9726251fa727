from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from renewline.llm import secrets
from tests.llm import data

KINDS = secrets.KINDS


def brute(text: str | None) -> list[tuple[int, int, int]]:
    """Spans from Python's regular expressions and plain entropy of every window."""
    text = text or ""
    out = []
    assign = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.ASCII):
        if len(m[1]) >= 8:
            out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            out.append((m.start(), 2, m.end()))
    w = secrets.WINDOW
    for kind, (chars, _, bound) in secrets.CLASSES.items():
        for m in re.finditer(rf"{chars}{{{w},}}", text):
            if any(re.search(p, m[0]) for p in secrets.ALLOWED):
                continue
            hot = []
            for i in range(len(m[0]) - w + 1):
                part = m[0][i : i + w]
                total = -sum(part.count(c) / w * math.log2(part.count(c) / w) for c in set(part))
                if total >= bound - 1e-5:
                    a, b = m.start() + i, m.start() + i + w
                    if hot and hot[-1][1] >= a:
                        hot[-1][1] = b
                    else:
                        hot.append([a, b])
            # A placeholder word silences the stretch that holds it, not the run.
            out += [(a, KINDS.index(kind), b) for a, b in hot if not re.search(secrets.PLACEHOLDER, text[a:b])]
    return sorted(out)


def texts() -> list[str | None]:
    rng = random.Random(5)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    b64 = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/") for _ in range(n))
    out = data.odd_texts() + [
        'token = "' + hexa(40) + '" and more',
        "PassWord:abc PASSWD=longenough api_key='k.e-y_/+=123' apikey : 12345678",
        "token=secret: \"abcdefghij\" token: api_key=12345678",
        "AKIA0123456789AB AKIAAKIA00000000 AKIAX akia0123456789ABCD",
        hexa(31) + "g" + hexa(32) + "-" + hexa(64),
        "id 123e4567-e89b-12d3-a456-426614174000 " + b64(60) + " tail " + b64(19),
        "/usr/local/share/applications/defaults " + "z" * 50 + hexa(10) + b64(30) + "z" * 50,
        "é😀 secret=" + b64(24) + "😀",
        "ſecret=abcdefghij toKen=abcdefghij Key",
        b64(30) + "example" + b64(30),
        "/srv/sample/" + "a" * 30 + "/" + b64(40),
        b64(40) + "=" * 25 + "dummy" + "=" * 25 + b64(40),
    ]
    for _ in range(40):
        out.append(" ".join(rng.choice([hexa, b64])(rng.randint(5, 60)) for _ in range(5)))
    return out


@pytest.fixture(scope="module")
def scanned(spark, tmp_path_factory):
    folder = data.parquet(data.documents(spark, texts()), tmp_path_factory.mktemp("secrets"))
    return secrets.op1_secret_scan(spark, folder).collect()


def test_spans_equal_brute_force(scanned):
    every = texts()
    for row in scanned:
        if row.doc_id is None:
            continue
        spans = brute(every[row.doc_id])
        shown = [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert row.spans == ",".join(shown), every[row.doc_id]
        base = ",".join(s for s, (_, k, _) in zip(shown, spans) if k < 3)
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == i for _, k, _ in spans) for i in range(3))


def test_every_row_has_a_result(scanned):
    assert len(scanned) == len(texts()) + 3
    null = [r for r in scanned if r.doc_id == 0]
    assert [(r.n_assign, r.spans) for r in null] == [(0, "")]


def test_empty_table(spark, tmp_path):
    folder = data.parquet(data.documents(spark, []), tmp_path)
    assert secrets.op1_secret_scan(spark, folder).count() == 0


def test_redaction_covers_all_spans_and_nothing_else(spark):
    docs = secrets.find_secrets(data.documents(spark, texts()), name="found")
    rows = docs.select("doc_id", "text", secrets.redact(F.col("text"), F.col("found"), "#").alias("masked")).collect()
    for row in rows:
        covered: list[list[int]] = []
        for a, _, b in brute(row.text):
            if covered and a < covered[-1][1]:
                covered[-1][1] = max(b, covered[-1][1])
            elif covered and a == covered[-1][1]:
                covered[-1][1] = b
            else:
                covered.append([a, b])
        expected, at = [], 0
        for a, b in covered:
            expected += [row.text[at:a], "#"]
            at = b
        assert row.masked == ("".join(expected) + row.text[at:] if covered else row.text)


def test_very_many_matches(spark):
    """Texts with more matches and stretches than a block of a fold holds, against brute force."""
    rng = random.Random(12)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [" ".join(hexa(32) for _ in range(n)) for n in (127, 128, 129, 700)]
    texts.append("=".join(rng.choice(["A" * 25, hexa(24) + "XyZ/+"]) for _ in range(900)))
    texts.append("é " + "x token=abcdefgh1 " * 400)
    # Runs of several pieces, with stretches over their borders and many within.
    texts.append("".join(rng.choice([hexa(64) + "XyZ/+", "A" * 40]) for _ in range(150)) + " " + hexa(5_000))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.find_secrets(docs, name="found")
    rows = found.select("doc_id", "found", secrets.redact(F.col("text"), F.col("found"), "#").alias("masked")).collect()
    assert len(rows) == 7
    for r in rows:
        text, spans = texts[r.doc_id], brute(texts[r.doc_id])
        assert [(s["start"], s["kind"], s["end"]) for s in r.found] == spans
        covered = [False] * len(text)
        for a, _, b in spans:
            covered[a:b] = [True] * (b - a)
        want = "".join("#" if c and (i == 0 or not covered[i - 1]) else "" if c else text[i] for i, c in enumerate(covered))
        assert r.masked == want
