from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from renewline.llm import repeats
from tests.llm import data


def plain(texts: list[str | None], length: int) -> list[tuple[int, list[tuple[int, int]], bytes]]:
    raw = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        edges = [i for i in range(len(t) + 1) if (i > 0 and gone[i - 1]) != (i < len(t) and gone[i])]
        spans = list(zip(edges[::2], edges[1::2]))
        out.append((len(t), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def mixed_texts(seed: int, length: int) -> list[str | None]:
    """Shared passages around the length, copies, edits, periodic text, all at random places."""
    rng = random.Random(seed)
    letters = "abcdé "
    fresh = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [fresh(length * k // 4) for k in (2, 3, 4, 5, 9)]
    out: list[str | None] = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(fresh(rng.randint(0, 2 * length)))
            parts.append(rng.choice(shared))
        out.append("".join(parts))
    for t in list(out[:10]):
        at = rng.randrange(len(t))
        out += [t, t[:at] + "#" + t[at + 1 :]]
    return out + [fresh(3) * length, "x" * length, "x" * (length + 1), "x" * (length - 1), None, ""]


@pytest.mark.parametrize("seed,length,together", [(1, 24, 1_000), (2, 41, 3), (3, 100, 0)])
def test_equal_to_brute_force(spark, seed, length, together):
    texts = mixed_texts(seed, length)
    docs = data.documents(spark, texts)
    rows = repeats.remove_repeats(docs, length=length, together=together).collect()
    # Rows with equal id and text have equal results, so they can be compared as sets of ids.
    plain_rows = docs.collect()
    expected = plain([r.text for r in plain_rows], length)
    got = sorted((str(r.doc_id), r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows)
    assert got == sorted((str(r.doc_id), n, spans, kept) for r, (n, spans, kept) in zip(plain_rows, expected))
    assert all(r.n_removed == sum(b - a for a, b in r.spans) for r in rows)


def test_short_pieces_change_nothing(spark, monkeypatch):
    texts = mixed_texts(5, 40)
    whole = sorted(map(str, repeats.remove_repeats(data.documents(spark, texts), length=40).collect()))
    monkeypatch.setattr(repeats, "BLOCK", 256)
    cut = sorted(map(str, repeats.remove_repeats(data.documents(spark, texts), length=40).collect()))
    assert cut == whole


def test_names_follow_content():
    rng = np.random.default_rng(3)
    for length in (16, 17, 24, 41, 400):
        block = rng.integers(97, 100, 900).astype(np.uint8)
        joined = np.concatenate([block, block])
        half, full = repeats.names(joined, length)
        assert (full[: 900 - length] == full[900 : 1_800 - length]).all()
        n = len(full)
        strings = [joined[i : i + length].tobytes() for i in range(n)]
        assert len(set(strings)) == len(set(full.tolist()))
        assert len(half) == len(joined) - (length + 1) // 2 + 1


def test_sliding_min():
    values = np.random.default_rng(1).integers(0, 50, 777).astype(np.uint64)
    for width in (1, 2, 7, 201, 777):
        assert repeats.sliding_min(values, width).tolist() == [min(values[i : i + width].tolist()) for i in range(777 - width + 1)]


def test_query(spark, tmp_path):
    passage = data.prose(50, 90)
    texts = data.odd_texts() + [data.prose(s, 60) + passage + data.prose(s + 30, 40) for s in range(60, 75)]
    docs = data.documents(spark, texts)
    rows = repeats.op3_remove_repeats(spark, data.parquet(docs, tmp_path)).collect()
    plain_rows = docs.collect()
    # The brute force keeps every string, so the longest text is left out of both sides.
    expected = plain([r.text for r in plain_rows if not r.text or len(r.text) < 100_000], 400)
    digests = {hashlib.sha256(kept).hexdigest() for _, _, kept in expected}
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count()
    assert {r.kept_sha256 for r in rows if r.n_bytes < 100_000} == digests
    assert by_id[0].n_bytes == by_id[0].n_removed == by_id[0].n_spans == 0


def test_empty_table(spark, tmp_path):
    assert repeats.op3_remove_repeats(spark, data.parquet(data.documents(spark, []), tmp_path)).count() == 0


def test_shared_passages_under_and_over_the_length(spark, tmp_path):
    """A passage of over 50 words goes if it has 400 bytes, and stays if it has fewer; ``n_bytes`` is the input's size."""
    rng = random.Random(21)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    own = lambda: " ".join(word(9) for _ in range(80))
    short = " ".join(word(5) for _ in range(60))
    exact = " ".join(word(7) for _ in range(60))[:400]
    longer = " ".join(word(6) for _ in range(90))
    assert len(short) < 400 < len(longer) and len(exact) == 400
    # Different characters around a passage, so that it is shared no farther.
    texts = [f"{own()} {i}{passage}{i} {own()}" for passage in (short, exact, longer) for i in range(3)] + [own()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in repeats.op3_remove_repeats(spark, data.parquet(docs, tmp_path)).collect()}
    for i, text in enumerate(texts):
        gone = 0 if i == 9 else (0, len(exact), len(longer))[i // 3]
        assert (rows[i].n_bytes, rows[i].n_removed, rows[i].n_spans) == (len(text), gone, int(gone > 0))
