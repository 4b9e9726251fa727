from __future__ import annotations

import gc
import random

import numpy as np
import pytest

from renewline.llm import tiling
from tests.llm import data


def plain_tiles(item: list, doc: list, least: int) -> int:
    """Words covered when the longest free common run is marked again and again."""
    used_i, used_d, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                    and i + n not in used_i and j + n not in used_d
                ):
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return covered
        used_i.update(range(i, i + n))
        used_d.update(range(j, j + n))
        covered += n


@pytest.mark.parametrize("seed", range(30))
def test_tiles_are_valid_and_as_long_as_greedy_ones(seed):
    rng = random.Random(seed)
    item = [rng.randint(1, 6) for _ in range(rng.randint(5, 25))]
    parts = [item[a : a + rng.randint(3, 12)] for a in rng.choices(range(len(item)), k=4)]
    doc = [x for p in parts for x in [*p, rng.randint(0, 6)]]
    found = tiling.tiles(np.array(item), np.array(doc), 3)
    places_i, places_d = [], []
    for i, j, n in found:
        assert n >= 3 and item[i : i + n] == doc[j : j + n] and 0 not in doc[j : j + n]
        places_i += range(i, i + n)
        places_d += range(j, j + n)
    assert len(set(places_i)) == len(places_i) and len(set(places_d)) == len(places_d)
    known = [x if x else -1 for x in doc]
    first = max((n for _, _, n in found), default=0)
    longest = max((n for n in range(len(item) + 1) for i in range(len(item) - n + 1) for j in range(len(doc) - n + 1) if item[i : i + n] == known[j : j + n]), default=0)
    assert first == (longest if longest >= 3 else 0)
    if not found:
        assert plain_tiles(item, known, 3) == 0


def test_hashes_name_equal_runs():
    ids = np.array([3, 1, 4, 1, 5, 9, 3, 1, 4, 1, 5, 2])
    for n in range(1, 13):
        hashes = tiling._hashes(ids, n)
        runs = [tuple(ids[i : i + n]) for i in range(len(ids) - n + 1)]
        assert len(hashes) == len(runs)
        assert len(set(hashes.tolist())) == len(set(runs))


ITEMS = [data.prose(s, 40) for s in range(100, 106)]


def leak_texts() -> list[str]:
    half = ITEMS[1].split()
    out = [
        data.prose(7, 80) + " " + ITEMS[0] + " " + data.prose(8, 80),
        " ".join(half[20:] + data.prose(9, 30).split() + half[:20]),
        ITEMS[2].upper().replace(" ", "!! "),
        " ".join(ITEMS[3].split()[:18]),
        " ".join(ITEMS[3].split()[:22]),
        ITEMS[4] + " " + ITEMS[5] + " " + ITEMS[4],
        data.prose(10, 400),
    ]
    return out


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(i, t, "x") for i, t in enumerate(ITEMS)] + [(90, None, "x"), (91, "", "x"), (92, "too few words", "x"), (None, ITEMS[0], "x"), (0, ITEMS[0], "x")]
    return spark.createDataFrame(rows, "item_id long, text string, score string")


def expected(texts):
    out = []
    for i, text in texts:
        doc = tiling.words(text)
        for item_id, item in [*enumerate(ITEMS), (None, ITEMS[0])]:
            words = tiling.words(item)
            numbers = {w: k for k, w in enumerate({*words, *doc})}
            covered = plain_tiles([numbers[w] for w in words], [numbers[w] for w in doc[:600]], 5)
            if covered >= 0.5 * len(words):
                out.append((str(i), str(item_id), covered))
    return sorted(out)


@pytest.mark.parametrize("block_chars", [16_000_000, 300])
def test_leaks_equal_brute_force(spark, benchmark, block_chars):
    texts = leak_texts()
    docs = data.documents(spark, texts)
    blocks = tiling.item_blocks(benchmark, block_chars=block_chars)
    assert (len(blocks) > 1) == (block_chars == 300)
    rows = tiling.find_leaks(docs, blocks).collect()
    found = sorted((str(r.doc_id), str(r.item_id), r.matched_words) for r in rows)
    assert found == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert all(abs(r.coverage - r.matched_words / r.item_words) < 1e-12 for r in rows)
    kept = tiling.drop_leaked(docs, blocks)
    leaked = {r.doc_id for r in rows}
    assert None not in leaked and kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in docs.collect() if r.doc_id not in leaked
    )


def test_odd_texts_and_empty_tables(spark, benchmark, tmp_path):
    docs = data.documents(spark, data.odd_texts())
    blocks = tiling.item_blocks(benchmark)
    assert tiling.drop_leaked(docs, blocks).count() == docs.count()
    empty = tiling.item_blocks(benchmark.where("false"))
    assert tiling.find_leaks(docs, empty).count() == 0
    data.parquet(benchmark, tmp_path, "benchmark")
    folder = data.parquet(data.documents(spark, []), tmp_path)
    assert tiling.op8_decontamination(spark, folder).count() == 0


def test_long_document_repeating_a_passage(spark):
    items = tiling.Items([(1, ITEMS[0])])
    assert [x[1:] for x in items.leaks((ITEMS[0] + " and ") * 3_000, 0.5)] == [(40, 1)]


@pytest.mark.parametrize("item,text,covered", [
    ("what is seven times", "He asked: What is seven times eight?", 4),
    ("what is seven times", "what is six times seven, what is", None),
    ("北京是中国的首都吗", "问：北京是中国的首都吗？答：是。", 9),
    ("東京タワーはどこ", "昔、東京タワーはどこにあるか", 8),
    ("東京タワーはどこ", "京都タワー、どこ", None),
    ("กรุงเทพ", "ฉันอยู่กรุงเทพนะ", 6),
    ("python 3 的作者是谁", "请问Python 3的作者是谁呢", 7),
])
def test_short_items_and_scripts_without_spaces(item, text, covered):
    found = tiling.Items([(1, item), (2, ITEMS[0])]).leaks(text, 0.5)
    assert [x[1] for x in found] == ([covered] if covered else [])


def test_words_of_spaced_scripts_are_as_before():
    text = "Größe naïve don't 3,5 слово कक한국어 北"
    assert tiling.words(text)[:-1] == tiling._PLAIN.findall(text.lower())[:-1] and tiling.words("北京 ab") == ["北", "京", "ab"]


def test_one_block_is_held_at_a_time(spark, benchmark, monkeypatch):
    alive = []
    plain = tiling.Items

    class Counted(plain):
        def __init__(self, *args):
            gc.collect()
            alive.append(sum(isinstance(o, plain) for o in gc.get_objects()))
            super().__init__(*args)

    monkeypatch.setattr(tiling, "Items", Counted)
    blocks = tiling.item_blocks(benchmark, block_chars=300)
    assert not alive and len(blocks) > 2
    tiling.drop_leaked(data.documents(spark, leak_texts()), blocks).count()
    assert len(alive) == len(blocks) and len(set(alive)) == 1
