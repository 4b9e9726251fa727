"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from renewline.llm import periodic
from tests.llm import data


def brute_runs(words, min_length=periodic.MIN_LENGTH, copies=periodic.COPIES):
    """(start, length, period) of every maximal stretch, by comparing all words for every period."""
    found = {}
    n = len(words)
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                j = i
                while j + q < n and words[j] == words[j + q]:
                    j += 1
                if j - i + q >= max(min_length, copies * q):
                    found.setdefault((i, j - i + q), q)
                i = j
            i += 1
    return sorted((start, length, q) for (start, length), q in found.items())


def brute_collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def random_words(rng: random.Random) -> list[int]:
    words = [rng.randrange(rng.choice([1, 2, 2, 3, 6])) for _ in range(rng.randint(0, 70))]
    if words and rng.random() < 0.6:
        at, period = rng.randrange(len(words)), rng.randint(1, 7)
        for i in range(at + period, len(words)):
            words[i] = words[i - period]
    return words


def found(texts):
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.array([w for t in texts for w in t], np.int64)
    out = [[] for _ in texts]
    for i, *run in zip(*(c.tolist() for c in periodic.find_runs(words, sizes))):
        out[i].append(tuple(run))
    return out


@pytest.mark.parametrize("at_once", [5, 64, 1 << 20])
def test_runs_equal_brute_force(monkeypatch, at_once):
    monkeypatch.setattr(periodic, "FIRST_CANDIDATES", min(at_once, periodic.FIRST_CANDIDATES))
    monkeypatch.setattr(periodic, "CANDIDATES", at_once)
    rng = random.Random(at_once)
    for _ in range(300):
        texts = [random_words(rng) for _ in range(rng.randint(1, 6))]
        assert found(texts) == [brute_runs(t) for t in texts]


def test_other_parameters():
    rng = random.Random(3)
    for _ in range(200):
        words = random_words(rng)
        got = periodic.find_runs(np.array(words, np.int64), np.array([len(words)]), min_length=4, copies=2)
        assert sorted(zip(*(c.tolist() for c in got[1:]))) == brute_runs(words, 4, 2)


def test_extensions_equal_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(100):
        body = rng.integers(0, rng.integers(1, 4), rng.integers(2, 60))
        symbols = np.concatenate(([10], np.tile(body, 3), [11]))
        levels = periodic.grammar(symbols)
        x, y = (rng.integers(0, len(symbols), 50) for _ in range(2))
        x, y = x[x != y], y[x != y]
        for a, b, n in zip(x, y, periodic.common_extension(levels, x, y)):
            k = 0
            while max(a, b) + k < len(symbols) and symbols[a + k] == symbols[b + k]:
                k += 1
            assert n == k


def test_long_texts_of_one_run():
    for period in (1, 3, 1_000):
        words = np.arange(120_000) % period
        assert found([words.tolist()]) == [[(0, 120_000, period)]]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def split(text):
    return text.encode().split() if text else []


def test_query_equals_brute_force(spark, tmp_path):
    texts = data.odd_texts()
    texts[7] = data.prose(1, 900)
    texts += [data.prose(i, 3 + 7 * i) for i in range(60)] + ["la la la la la la", "one two " * 30, "x " * 3_000]
    docs = data.documents(spark, texts)
    rows = periodic.op11_periodic_runs(spark, data.parquet(docs, tmp_path)).collect()
    got = sorted((tuple(r) for r in rows), key=repr)
    want = []
    for r in docs.collect():
        words = planted(r.doc_id, split(r.text))
        runs = brute_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = b" ".join(brute_collapsed(words, runs))
        milli = 1000 * best[1] // best[2] if runs else None
        want.append((r.doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want, key=repr)
    assert sum(r.n_runs for r in rows) > 5


def test_operator_keeps_its_own_interface(spark):
    rows = spark.createDataFrame([(1, "a b a b a b a b c"), (None, None)], "key long, body string")
    got = {r.doc_id: r for r in periodic.periodic_runs(rows, "key", "body").collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 8, 2)] and got[1].collapsed == "a b c" and got[1].n_words == 9
    assert got[None].runs == [] and got[None].collapsed == "" and got[None].n_words == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(rows, "key", "body", copies=1)


def test_empty_table(spark, tmp_path):
    assert periodic.op11_periodic_runs(spark, data.parquet(data.documents(spark, []), tmp_path)).count() == 0
