"""Suffix tree scores against a tree of plain dictionaries."""

from __future__ import annotations

import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from renewline.llm import suffixtree
from tests.llm import data

END = None


def symbols(text):
    return [*(text.encode().lower().split() if text else []), END]


class BruteTree:
    """Counts of all contexts, distributions by recursion, states by the divergence from the suffix."""

    def __init__(self, texts, max_depth, min_count, min_next, divergence):
        self.counts = Counter(w for t in texts for w in symbols(t))
        self.tokens = sum(self.counts.values())
        seen, behind = Counter(), defaultdict(Counter)
        for t in texts:
            row = symbols(t)
            for i in range(len(row)):
                for d in range(1, min(max_depth, i) + 1):
                    seen[tuple(row[i - d : i])] += 1
                    behind[tuple(row[i - d : i])][row[i]] += 1
        frequent = {w for w, n in self.counts.items() if n >= min_count}
        self.seen = seen
        self.behind = {
            s: {w: n for w, n in behind[s].items() if n >= min_next and w in frequent}
            for s in seen if seen[s] >= min_count and all(w in frequent for w in s)
        }
        self.behind = {s: b for s, b in self.behind.items() if b}
        self.weights = {}
        states = {s for s in self.behind if self.diverges(s) >= divergence}
        self.states = {s[k:] for s in states for k in range(len(s))}

    def rest(self, s):
        return 1 - sum(n - suffixtree.DISCOUNT for n in self.behind[s].values()) / self.seen[s]

    def weight(self, s):
        return self.rest(s) / (1 - sum(self.p(s[1:], w) for w in self.behind[s]))

    def p(self, s, w):
        if not s:
            return (self.counts[w] + 0.5) / (self.tokens + 0.5 * (len(self.counts) + 1))
        if s not in self.behind:
            return self.p(s[1:], w)
        if w in self.behind[s]:
            return (self.behind[s][w] - suffixtree.DISCOUNT) / self.seen[s]
        if s not in self.weights:
            self.weights[s] = self.weight(s)
        return self.weights[s] * self.p(s[1:], w)

    def diverges(self, s):
        pairs = [(self.p(s, w), self.p(s[1:], w)) for w in self.behind[s]]
        return sum(p * math.log(p / q) for p, q in pairs) + self.rest(s) * math.log(self.weight(s))

    def score(self, text, max_depth):
        row, total, base = symbols(text), 0.0, 0.0
        for i, w in enumerate(row):
            states = (tuple(row[i - d : i]) for d in range(min(max_depth, i), 0, -1))
            total += math.log10(self.p(next((s for s in states if s in self.states), ()), w))
            base += math.log10(self.p((), w))
        return total, base


def phrases(seed, count):
    """Texts of words that depend on the two before them, of rare words and of repeated phrases."""
    rng = random.Random(seed)
    follow = {}
    out = []
    for _ in range(count):
        words = ["a", "b"]
        for _ in range(rng.randint(0, 60)):
            if rng.random() < 0.15:
                words.append("rare%d" % rng.randrange(500))
            elif rng.random() < 0.3:
                words.append(rng.choice("abcdef"))
            else:
                words.append(follow.setdefault((words[-2], words[-1]), rng.choice("ABCDefgh")))
        out.append(" ".join(words[rng.randint(0, 2) :]))
    return out


def out(row):
    return row.n_tokens, row.n_known, row.score, row.base_score


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_scores_equal_brute_force(spark, monkeypatch, depth):
    monkeypatch.setattr(suffixtree, "BLOCK_BYTES", 2_000)
    texts = phrases(depth, 300) + [None, "", "  ", "A b\tC\n d", "unseen words only", "é ſ ÀB"]
    learned = texts[: len(texts) // 2]
    options = {"max_depth": depth, "min_count": 8, "min_next": 2}
    every = BruteTree(learned, **options, divergence=0.0)
    found = sorted(every.diverges(s) for s in every.behind)
    # Between two of them, so that about half of the contexts pass on their own.
    options["divergence"] = (found[len(found) // 2 - 1] + found[len(found) // 2]) / 2
    brute = BruteTree(learned, **options)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tree = suffixtree.learn(docs.where(F.col("doc_id") < len(learned)), filter_bits=14, **options)
    assert tree.states.count() == len(brute.states) < len(brute.behind)
    assert Counter(map(len, brute.states))[depth] > 3
    rows = suffixtree.score(docs, tree).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        score, base = brute.score(texts[r.doc_id], depth)
        row = symbols(texts[r.doc_id])
        assert out(r) == (len(row), sum(w in brute.counts for w in row), pytest.approx(score), pytest.approx(base))


def test_distributions_sum_to_one():
    brute = BruteTree(phrases(9, 200), 2, 8, 2, 0.05)
    for s in list(brute.states)[:20]:
        assert sum(brute.p(s, w) for w in brute.counts) + brute.p(s, "never") == pytest.approx(1)


def test_held_out_texts_score_better_than_single_words(spark, tmp_path, monkeypatch):
    texts = phrases(5, 9_000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = suffixtree.op12_lm_scoring(spark, data.parquet(docs, tmp_path)).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 9_000 and len(held) > 1_200
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held) and all(r.score < 0 for r in held)
    learned = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    tokens = sum(len(symbols(t)) for t in learned)
    least = max(suffixtree.MIN_COUNT, math.ceil(suffixtree.MIN_SHARE * tokens))
    brute = BruteTree(learned, suffixtree.MAX_DEPTH, least, suffixtree.MIN_NEXT, suffixtree.DIVERGENCE)
    for r in rows:
        score, base = brute.score(texts[r.doc_id], suffixtree.MAX_DEPTH)
        assert (r.score, r.base_score) == (pytest.approx(score), pytest.approx(base))
        assert r.train_tokens == brute.tokens and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)


def test_query_learns_rare_contexts_and_symbols(spark, tmp_path):
    """Contexts seen once or twice among many words count, and so does what stands once behind them."""
    texts = phrases(7, 600) + ["only here stands this line"] * 9 + [f"lone{i} pair{i} of{i} words{i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    learned = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    brute = BruteTree(learned, 3, 1, 1, suffixtree.DIVERGENCE)
    assert ("lone0".encode(), b"pair0", b"of0") in brute.behind
    rows = suffixtree.op12_lm_scoring(spark, data.parquet(docs, tmp_path)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        score, base = brute.score(texts[r.doc_id], 3)
        assert (r.score, r.base_score) == (pytest.approx(score), pytest.approx(base))


@pytest.mark.parametrize("options", [{}, {"min_count": 5, "min_next": 2}])
def test_parts_words_in_several_parts_and_words_without_a_code(spark, monkeypatch, options):
    """However words are coded and dealt to parts, the tree is the same."""
    texts = phrases(11, 150) + ["the the the the the the cat"] * 5 + [None, "", "never seen", "the rare1 never a b"]
    learned = texts[::2]
    brute = BruteTree(learned, 3, options.get("min_count", 1), options.get("min_next", 1), 0.02)
    # About 20 parts; the commonest words lie in several of them. Words seen once or twice have no code.
    monkeypatch.setattr(suffixtree, "PART_TOKENS", 120)
    monkeypatch.setattr(suffixtree, "ROWS_AT_ONCE", 30)
    monkeypatch.setattr(suffixtree, "COMMON", 40)
    monkeypatch.setattr(suffixtree, "TOKENS_AT_ONCE", 300)
    monkeypatch.setattr(suffixtree, "BLOCK_BYTES", 1_000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tree = suffixtree.learn(docs.where(F.col("doc_id") % 2 == 0), **options)
    assert tree.codes.parts > 10 and 1 < len(tree.codes.hot) < len(tree.codes.names) < len(brute.counts) / 3
    assert tree.codes.shares.max() > 2
    names = [r.key for r in tree.states.collect()]
    assert len(names) == len(set(names)) == len(brute.states)
    assert tree.grams.count() == sum(len(brute.behind[s]) for s in brute.states)
    rows = suffixtree.score(docs, tree).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    rows += suffixtree.score(docs, tree, learned=F.col("doc_id") % 2 == 0).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        row, (score, base) = symbols(texts[r.doc_id]), brute.score(texts[r.doc_id], 3)
        assert out(r) == (len(row), sum(w in brute.counts for w in row), pytest.approx(score), pytest.approx(base))


def test_what_is_kept_of_a_tree_stays_small(spark, tmp_path, monkeypatch):
    """No tables of all contexts and symbols are written: at most ten bytes a token are kept to learn and score."""
    kept = []
    plain = suffixtree.materialize
    monkeypatch.setattr(suffixtree, "materialize", lambda df: kept.append(plain(df)) or kept[-1])
    texts = [" ".join(f"w{(i * 7919 + j * j * 31) % 997}" for j in range(200)) for i in range(1_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = spark.read.parquet(f"{data.parquet(docs, tmp_path)}/documents.parquet")
    assert suffixtree.score(docs, suffixtree.learn(docs)).count() == len(texts)
    sizes = [os.path.getsize(f.removeprefix("file://")) for df in kept for f in df.inputFiles()]
    assert 0 < sum(sizes) < 10 * 201 * len(texts)


@pytest.mark.parametrize("bits", [3, 14])
def test_filters_that_would_be_full_are_left_out(spark, bits):
    texts = phrases(8, 200)
    brute = BruteTree(texts, 2, 1, 1, 0.02)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tree = suffixtree.learn(docs, max_depth=2, min_count=1, min_share=0.0, min_next=1, filter_bits=bits)
    assert (tree.gram_filter is None) == (bits == 3)
    assert tree.states.count() == len(brute.states)
    for r in suffixtree.score(docs, tree).collect():
        assert r.score == pytest.approx(brute.score(texts[r.doc_id], 2)[0])


def test_odd_texts_and_repeated_rows(spark, tmp_path):
    docs = data.documents(spark, data.odd_texts())
    rows = suffixtree.op12_lm_scoring(spark, data.parquet(docs, tmp_path)).collect()
    kept = docs.where(~suffixtree.held_out(F.col("doc_id"))).collect()
    assert len(rows) == docs.count() and rows[0].train_tokens == sum(len(symbols(r.text)) for r in kept)
    want = Counter((r.doc_id, len(symbols(r.text))) for r in docs.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == want
    for r in rows:
        assert r.held_out in (True, False)
        assert math.isfinite(r.score) and r.score <= 0


def test_no_rows_and_nothing_to_learn(spark, tmp_path):
    assert suffixtree.op12_lm_scoring(spark, data.parquet(data.documents(spark, []), tmp_path)).count() == 0
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    row = suffixtree.score(docs, suffixtree.learn(docs.where("false"))).first()
    assert out(row) == (3, 0, 0.0, 0.0)


def test_names_are_those_of_spark(spark):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-(2**63), 2**63, 20) for _ in range(2))
    rows = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long")
    want = [r[0] for r in rows.select(F.xxhash64("a", "b")).collect()]
    assert suffixtree.joined(a.view(np.uint64), b.view(np.uint64)).view(np.int64).tolist() == want
    words = [b"", b"word", "é longer than thirty-two bytes in one word".encode()]
    rows = spark.createDataFrame([(w,) for w in words], "w binary")
    want = [xxhash.xxh64_intdigest(w, 42) for w in words]
    assert [r[0] % 2**64 for r in rows.select(F.xxhash64("w")).collect()] == want


def test_filter_lets_every_key_pass(spark):
    keys = np.random.default_rng(3).integers(-(2**63), 2**63, 500)
    made = suffixtree.key_filter(spark.createDataFrame([(k,) for k in keys.tolist()], "key long"), 14)
    assert suffixtree.passes(made, keys.view(np.uint64)).all()
    others = np.random.default_rng(4).integers(0, 2**63, 5_000).view(np.uint64)
    assert suffixtree.passes(made, others).mean() < 0.02
