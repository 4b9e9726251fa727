"""Language-model scoring with a probabilistic suffix tree.

The symbols are a text's words, lower-cased, and one end. A state of the tree is a context:
up to ``MAX_DEPTH`` words that stand before a symbol.

1. Words are counted. The commonest, a bounded number, get short codes; other words go by their hash.
2. Every place of a text is a row: the words before it, nearest first, and its symbol. Rows go to the part that the
   nearest word falls into, so that a part holds whole branches of the tree; words with more places than a part should
   have are dealt to several by the word before them. A part's rows are counted.
3. In a part, every context counts every symbol behind it. A state's own distribution holds
   those, less a discount; what they leave goes to all other symbols, in the proportions of its
   suffix, the context without its earliest word, and at the root of the smoothed shares of single
   words. So every distribution sums to 1. Callers can ask for contexts that make up ``min_share`` of
   all symbols or are seen ``min_count`` times, and symbols seen ``min_next`` times; by default none is left out.
4. A state is retained if its distribution diverges from its suffix's by ``DIVERGENCE`` (in nats, by
   Kullback and Leibler), or if a retained state ends in it.

A symbol is scored in the longest suffix of its text that is a retained state.

No tables of all states and symbols are written, which would be many times the input: a part makes its states from its
rows when they are needed. To score texts, their places go to the same parts, packed too, and the parts return what each
text gains over single words.
"""

from __future__ import annotations

import math
import struct
from collections import Counter
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renewline.llm.common import FILTER_BITS, key_filter, materialize, passes, small_batches

MAX_DEPTH = 3
#: A context stands for at least this share of all symbols, and is seen at least so often. So low, all are learned.
MIN_SHARE = 0.0
MIN_COUNT = 1
MIN_NEXT = 1
DISCOUNT = 0.75
DIVERGENCE = 0.02
#: Distinct words that a task remembers, and tokens that it packs at once.
WORDS_AT_ONCE = 1 << 18
TOKENS_AT_ONCE = 1 << 18
#: Words with a short code, at most.
COMMON = 1 << 19
#: Bytes of the texts of a block.
BLOCK_BYTES = 3 << 20
#: Learned tokens of a part; a word with more places is dealt to several parts.
PART_TOKENS = 3 << 18
#: Rows of a part whose branches are made at once, about.
ROWS_AT_ONCE = 1 << 18

#: The end of a text, as a word. Words are never empty.
END = b""
#: Codes: no word (before the text), the end, then common words. Other words are hashes with the highest bit set.
NO_WORD, END_CODE, FIRST_CODE = 0, 1, 2
RARE = np.uint64(1 << 63)
#: Packed in place of a word without a code.
ESCAPE = 0xFFFFFF

SEED = 42
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _hash_long(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of eight bytes."""
    h = (seed + _P5 + np.uint64(8)) ^ (_rotated(value * _P2, 31) * _P1)
    h = _rotated(h, 27) * _P1 + _P4
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The name of a sequence and one more symbol, as Spark's xxhash64 of two longs."""
    return _hash_long(second, _hash_long(first, np.full(len(first), SEED, np.uint64)))


# Texts as symbols ------------------------------------------------------------


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, lower-cased, one text after the other, and how many each has.

    Only A to Z are lower-cased, and words are parted by ASCII white space.
    """
    texts = pc.fill_null(texts.view(pa.string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    # A text without words comes as one empty word.
    blank = pc.equal(pc.binary_length(lists.flatten()), 0)
    starts = np.cumsum(sizes) - sizes
    sizes = sizes - np.add.reduceat(blank.to_numpy(zero_copy_only=False).astype(np.int64), starts) if len(sizes) else sizes
    return lists.flatten().filter(pc.invert(blank)), sizes


class Codes:
    """Codes of words, their counts, and the parts that contexts fall into."""

    def __init__(self, common: pa.Table, ends: int, tokens: int):
        names, counts = (common[c].to_numpy() for c in ("key", "n"))
        order = np.argsort(-counts, kind="stable")
        counts = np.concatenate([[0, ends], counts[order]]).astype(np.int64 if tokens >> 31 else np.int32)
        self.__setstate__((names[order].view(np.uint64), counts, max(1, -(-tokens // PART_TOKENS)), PART_TOKENS))

    def __getstate__(self):
        # Tasks make the tables again.
        return self.in_order, self.counts, self.parts, self.part_tokens

    def __setstate__(self, state):
        self.in_order, self.counts, self.parts, self.part_tokens = state
        by_name = np.argsort(self.in_order)
        self.names, self.codes = self.in_order[by_name], (by_name + FIRST_CODE).astype(np.uint32)
        self.share_of = np.clip(-(-self.counts // self.part_tokens), 1, self.parts).astype(np.int32)
        self.share_of[:FIRST_CODE] = 1
        hot = np.flatnonzero(self.share_of > 1)
        self.hot, self.shares = hot.astype(np.uint64), self.share_of[hot]

    def nameless(self) -> Codes:
        """The same for tasks that read no words."""
        out = Codes.__new__(Codes)
        out.__setstate__((self.in_order[:0], self.counts, self.parts, self.part_tokens))
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        digest = xxhash.xxh64_intdigest
        names = np.array([digest(w, SEED) for w in words], np.uint64)
        at, found = find(self.names, names)
        codes = names | RARE
        codes[found] = self.codes[at[found]]
        return codes

    def share(self, word: np.ndarray) -> np.ndarray:
        """In how many parts the contexts lie whose nearest word this is."""
        return self.share_of[np.where(word < RARE, word, 0)]

    def part(self, nearest: np.ndarray, second: np.ndarray) -> np.ndarray:
        own = self.first_part(nearest)
        share = self.share(nearest)
        hot = np.flatnonzero(share > 1)
        own[hot] += (joined(nearest[hot], second[hot]) % share[hot].astype(np.uint64)).astype(np.int32)
        return own % np.int32(self.parts)

    def first_part(self, nearest: np.ndarray) -> np.ndarray:
        return (_hash_long(nearest, np.full(len(nearest), SEED, np.uint64)) % np.uint64(self.parts)).astype(np.int32)


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys stand in a sorted table, and which do."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    order = np.argsort(keys)
    at = np.empty(len(keys), np.int64)
    at[order] = np.minimum(np.searchsorted(table, keys[order]), len(table) - 1)
    return at, table[at] == keys


class Places:
    """The places of some texts, one text after the other."""

    def __init__(self, texts: pa.Array, codes: Codes):
        words, sizes = split(texts)
        coded = words.dictionary_encode()
        self.words = coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False)
        self.codes = codes.of(self.words.tolist())
        self.sizes = sizes + 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        last = np.zeros(self.sizes.sum(), bool)
        last[self.starts + sizes] = True
        #: Numbers of distinct words; the last number is that of the end.
        self.at = np.full(len(last), len(self.codes), np.int64)
        self.at[~last] = coded.indices.to_numpy(zero_copy_only=False)
        self.symbols = np.append(self.codes, np.uint64(END_CODE))[self.at]
        self.text = np.repeat(np.arange(len(sizes)), self.sizes)

    def rows(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place with a word before it: ``depth`` words, nearest first, and the symbol; and its text."""
        since = np.arange(len(self.at)) - self.starts[self.text]
        rows = np.flatnonzero(since)
        out = np.zeros((depth + 1, len(rows)), np.uint64)
        for d in range(1, depth + 1):
            there = since[rows] >= d
            out[d - 1, there] = self.symbols[rows[there] - d]
        out[depth] = self.symbols[rows]
        return out, self.text[rows]


def pack(rows: np.ndarray, more: np.ndarray) -> bytes:
    """Rows column by column, each byte of the codes on its own, and one more array, compressed.

    The first column is packed as differences, which are small where rows are in its order.
    """
    flat = rows.astype(np.uint64)
    flat[0, 1:] -= rows[0, :-1]
    flat = flat.ravel()
    common = flat < ESCAPE
    low = np.where(common, flat, ESCAPE).astype("<u4").view(np.uint8).reshape(-1, 4)
    out = []
    for array in (low[:, 0], low[:, 1], low[:, 2], flat[~common], more.astype(np.int64)):
        raw = array.tobytes()
        small = pa.compress(raw, codec="zstd", asbytes=True) if raw else b""
        out += [struct.pack("<II", len(raw), len(small)), small]
    return b"".join(out)


def unpack(packed: bytes, columns: int) -> tuple[np.ndarray, np.ndarray]:
    at, arrays = 0, []
    for kind in (np.uint8, np.uint8, np.uint8, np.uint64, np.int64):
        size, small = struct.unpack_from("<II", packed, at)
        at += 8
        raw = pa.decompress(packed[at : at + small], size, codec="zstd", asbytes=True) if size else b""
        arrays.append(np.frombuffer(raw, kind))
        at += small
    flat = arrays[0].astype(np.uint64)
    for k in (1, 2):
        flat |= arrays[k].astype(np.uint64) << np.uint64(8 * k)
    flat[flat == ESCAPE] = arrays[3]
    rows = flat.reshape(columns, -1)
    rows[0] = np.cumsum(rows[0], dtype=np.uint64)
    return rows, arrays[4]


def pack_places(rows: np.ndarray, text: np.ndarray, more: np.ndarray) -> bytes:
    """Rows with their texts, the latter as differences under a nearest word: small, where rows are in the order of both."""
    new = _changes(rows[0])
    step = np.diff(text, prepend=0)
    return pack(np.concatenate([rows, np.where(new, text, step).astype(np.uint64)[None]]), more)


def unpack_places(packed: bytes, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, more = unpack(packed, columns + 1)
    new, step = _changes(rows[0]), rows[-1].astype(np.int64)
    ahead = np.cumsum(step)
    text = ahead - (ahead - step)[new][np.cumsum(new) - 1]
    return rows[:-1], text.astype(np.int32), more


def _changes(x: np.ndarray) -> np.ndarray:
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return new


def group(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, in the order of the keys, and the number of each key among them."""
    order = np.argsort(keys)
    new = _changes(keys[order])
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return order[new], place


def named(rows: np.ndarray) -> np.ndarray:
    name = rows[0]
    for column in rows[1:]:
        name = joined(name, column)
    return name


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


# Learning --------------------------------------------------------------------


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """Columns ``word`` (binary; empty for the end) and ``n``."""

    def count(batches):
        held: Counter = Counter()

        def handed():
            names = ["word", "n"]
            return pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names)

        for batch in batches:
            words, sizes = split(batch.column(0))
            found = words.value_counts()
            distinct = found.field(0).view(pa.binary()).to_numpy(zero_copy_only=False)
            for word, n in zip(distinct.tolist(), found.field(1).to_numpy().tolist()):
                held[word] += n
            held[END] += len(sizes)
            if len(held) >= WORDS_AT_ONCE:
                yield handed()
                held.clear()
        if held:
            yield handed()

    rows = docs.select(F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _merged(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and their counts."""
    first, place = group(named(rows))
    return rows[:, first], np.bincount(place, minlength=len(first))


def _parts(rows: np.ndarray, codes: Codes) -> np.ndarray:
    return codes.part(rows[0], rows[1] if len(rows) > 2 else np.zeros(rows.shape[1], np.uint64))


def _by_part(rows: np.ndarray, codes: Codes, text: np.ndarray | int = 0) -> list[tuple[int, np.ndarray]]:
    """Parts and the places of their rows, by the nearest word and the text where numbers are small enough."""
    part = _parts(rows, codes)
    key = (part.astype(np.uint64) << np.uint64(40)) | (np.minimum(rows[0], (1 << 22) - 1) << np.uint64(18))
    order = np.argsort(key | np.minimum(text, (1 << 18) - 1).astype(np.uint64))
    starts = np.flatnonzero(_changes(part[order]))
    return list(zip(part[order[starts]].tolist(), np.split(order, starts[1:]))) if len(starts) else []


def _of_rows(docs: DataFrame, text: str, depth: int, codes: Codes, told, schema: str) -> DataFrame:
    """What ``told`` makes of the rows of every TOKENS_AT_ONCE tokens."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(Places(batch.column(0), codes).rows(depth)[0])
            size += held[-1].shape[1]
            if size >= TOKENS_AT_ONCE:
                yield told(np.concatenate(held, axis=1))
                held, size = [], 0
        if size:
            yield told(np.concatenate(held, axis=1))

    return docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, schema)


def count_rows(docs: DataFrame, text: str, depth: int, codes: Codes) -> DataFrame:
    """Columns ``part`` and ``packed``: distinct rows of parts with their counts, which add up."""

    def told(rows: np.ndarray) -> pa.RecordBatch:
        rows, n = _merged(rows)
        found = [(part, pack(rows[:, at], n[at])) for part, at in _by_part(rows, codes)]
        return pa.record_batch(
            [pa.array([p for p, _ in found], pa.int32()), pa.array([r for _, r in found], pa.binary())], ["part", "packed"]
        )

    return _of_rows(docs, text, depth, codes, told, "part int, packed binary")


def beside(docs: DataFrame, text: str, vocabulary: DataFrame, depth: int, codes: Codes) -> DataFrame:
    """What parts need to know beside their own rows.

    Columns ``part``, ``nearest``, ``next``, ``n`` and ``of_next``: how often a rare symbol of the part was seen (``of_next``; ``nearest``
    is null), and for a word in several parts, how often each symbol stands behind it in all of them (``n``).
    """
    second = min(depth, 2)

    def told(rows: np.ndarray) -> pa.RecordBatch:
        symbol = rows[-1]
        rare = np.flatnonzero(symbol >= RARE)
        part = _parts(rows[:, rare], codes)
        first, _ = group(joined(part.astype(np.uint64), symbol[rare]))
        rare, part = rare[first], part[first]
        hot = np.flatnonzero(codes.share(rows[0]) > 1)
        first, place = group(joined(rows[0][hot], symbol[hot]))
        pairs = hot[first]
        times = np.bincount(place, minlength=len(first))
        return pa.record_batch(
            [
                pa.concat_arrays([pa.array(part), pa.nulls(len(pairs), pa.int32())]),
                pa.concat_arrays([pa.nulls(len(rare), pa.int64()), _signed(rows[0][pairs])]),
                _signed(symbol[np.concatenate([rare, pairs])]),
                pa.concat_arrays([pa.nulls(len(rare), pa.int64()), pa.array(times.astype(np.int64))]),
            ],
            ["part", "nearest", "next", "n"],
        )

    asked = _of_rows(docs, text, second, codes, told, "part int, nearest long, next long, n long")
    asked = asked.groupBy("part", "nearest", "next").agg(F.sum("n").alias("n"))
    if len(codes.hot):
        first = codes.first_part(codes.hot)
        lists = [
            (int(w), [int((f + k) % codes.parts) for k in range(s)])
            for w, f, s in zip(codes.hot.tolist(), first, codes.shares.tolist())
        ]
        # The parts of the words in several of them: no more than twice as many as there are parts.
        parts = docs.sparkSession.createDataFrame(lists, "nearest long, parts array<int>")
        asked = asked.join(F.broadcast(parts), "nearest", "left")
        one = F.array("part")
        asked = asked.select(F.explode(F.coalesce("parts", one)).alias("part"), "nearest", "next", "n")
    known = vocabulary.where(F.col("word") != F.lit(END)).select(
        F.xxhash64("word").bitwiseOR(F.lit(-(1 << 63)).cast("long")).alias("next"), F.col("n").alias("of_next")
    )
    return asked.join(known, "next", "left").select("part", "nearest", "next", "n", "of_next")


class Branches:
    """The branches of the tree in a part: for each depth contexts and the symbols behind them."""

    def __init__(self, rows: np.ndarray, n: np.ndarray, more: pa.Table, tree: Tree):
        codes, depth = tree.codes, tree.depth
        symbols = rows[depth]
        nearest, of, seen, of_next = (more[c].combine_chunks() for c in ("nearest", "next", "n", "of_next"))
        pairs = pc.is_valid(nearest).to_numpy(zero_copy_only=False)
        of = of.to_numpy().view(np.uint64)
        of_next = pc.fill_null(of_next, 0).to_numpy()
        order = np.argsort(of)
        table, rare_counts = of[order], of_next[order]

        def counts(symbol: np.ndarray) -> np.ndarray:
            out = np.zeros(len(symbol), np.int64)
            common = symbol < RARE
            out[common] = codes.counts[symbol[common].astype(np.int64)]
            at, found = find(table, symbol[~common])
            out[~common] = np.where(found, rare_counts[at] if len(table) else 0, 0)
            return out

        self.levels, self.rows, self.nearest = [], rows.shape[1], rows[0].copy()
        name, before = None, None
        for d in range(1, depth + 1):
            there = np.flatnonzero(rows[d - 1] != NO_WORD).astype(np.int32)
            name = rows[0] if d == 1 else joined(name, rows[d - 1])
            at, behind, times = name[there], symbols[there], n[there]
            if d == 1:
                # What stands behind a word in several parts is counted over all of them.
                times = np.where(codes.share(at) > 1, 0, times)
                at = np.concatenate([at, pc.fill_null(nearest, 0).to_numpy().view(np.uint64)[pairs]])
                behind = np.concatenate([behind, of[pairs]])
                times = np.concatenate([times, pc.fill_null(seen, 0).to_numpy()[pairs]])
            first, place = group(joined(at, behind))
            times = np.bincount(place, times, len(first))
            behind = behind[first]
            which, context = group(at[first])
            contexts = at[first[which]]
            total = np.bincount(context, times, len(contexts))
            of_behind = counts(behind)
            root = (of_behind + 0.5) / (tree.tokens + 0.5 * (tree.words + 1))
            if d == 1:
                below, parent = root, np.zeros(len(contexts), np.int64)
            else:
                lower = before[there[first]]
                below, parent = self.levels[-1]["p"][lower], self.levels[-1]["context"][lower[which]]
            # A symbol counts where it and the context are seen often enough.
            stored = (times >= tree.min_next) & (of_behind >= tree.min_count) & (total[context] >= tree.min_count)
            less = np.where(stored, times - DISCOUNT, 0.0)

            def summed(x: np.ndarray) -> np.ndarray:
                return np.bincount(context, x, len(contexts))

            is_state = summed(stored) > 0
            # What the stored symbols leave goes to the others, in the proportions they have in the suffix.
            rest = 1 - summed(less) / np.maximum(total, 1)
            weight = rest / np.maximum(1e-12, 1 - summed(np.where(stored, below, 0.0)))
            own = less / np.maximum(total, 1)[context]
            apart = summed(own * np.log(np.where(stored, own / below, 1.0))) + rest * np.log(weight)
            p = np.where(stored, own, np.where(is_state, weight, 1.0)[context] * below)
            gain = np.zeros(len(stored))
            gain[stored] = np.log10(own[stored]) - np.log10(root[stored])
            self.levels.append({
                "contexts": contexts, "context": context, "parent": parent, "total": total, "weight": weight,
                "divergence": apart, "next": behind, "stored": stored, "p": p, "gain": gain,
                "is_state": is_state, "kept": is_state & (apart >= tree.divergence), "rows": there, "place": place[: len(there)],
            })
            # The place of every row among the keys of this depth.
            before = np.zeros(rows.shape[1], np.int32)
            before[there] = place[: len(there)]
        for upper, lower in zip(self.levels[-2::-1], self.levels[:0:-1]):
            upper["kept"][lower["parent"][lower["kept"]]] = True
        level = self.levels[0]
        #: Words in several parts: those that are retained for what this part has, and those that other parts decide on.
        several = codes.share(level["contexts"]) > 1
        self.ends = level["contexts"][several & level["kept"]]
        self.open = level["contexts"][several & ~level["kept"] & level["is_state"]]

    def keep(self, words: np.ndarray):
        self.levels[0]["kept"] |= np.isin(self.levels[0]["contexts"], words)

    def gains(self, rows: int) -> np.ndarray:
        """For each of the last rows, log10 of its symbol's probability less that under single words."""
        out = np.zeros(self.rows)
        for level in self.levels:
            kept = level["kept"][level["context"]][level["place"]]
            at, place = level["rows"][kept], level["place"][kept]
            weight = np.log10(level["weight"])[level["context"]]
            out[at] = np.where(level["stored"][place], level["gain"][place], out[at] + weight[place])
        return out[self.rows - rows :]


def _branches(table: pa.Table, tree: Tree, rows: np.ndarray | None = None, n: np.ndarray | None = None):
    """The branches of a part, some at a time: the numbers of their rows, and the branches.

    They come from the part's counted rows, more rows, and what stands beside them.
    """
    pieces = [unpack(x.as_py(), tree.depth + 1) for x in table["packed"].filter(pc.is_valid(table["packed"]))]
    if rows is None:
        rows, n = np.zeros((tree.depth + 1, 0), np.uint64), np.zeros(0, np.int64)
    if pieces:
        rows = np.concatenate([*(r for r, _ in pieces), rows], axis=1)
        n = np.concatenate([*(n for _, n in pieces), n])
    beside = table.filter(pc.is_valid(table["next"])).select(["nearest", "next", "n", "of_next"]).combine_chunks()
    shares = max(1, rows.shape[1] // ROWS_AT_ONCE)
    of_beside = pc.fill_null(beside["nearest"], 0).to_numpy().view(np.uint64)
    mine, theirs = _share(rows[0], shares), _share(of_beside, shares)
    rare = pc.is_null(beside["nearest"]).to_numpy()
    for k in range(shares):
        which = np.flatnonzero(mine == k)
        found = Branches(rows[:, which], n[which], beside.filter(pa.array(rare | (theirs == k))), tree)
        found.all = rows.shape[1]
        yield which, found


def _share(word: np.ndarray, shares: int) -> np.ndarray:
    return ((word * _P1) >> np.uint64(40)) % np.uint64(shares)


class Tree:
    """A learned tree: the counts of words, what stands beside the rows of parts, the numbers that scoring needs, and the
    documents it is of, whose rows are counted where they are asked for."""

    def __init__(self, docs, text, vocabulary, codes: Codes, tokens: int, words: int, depth: int, min_count, min_next, divergence, filter_bits):
        self.docs, self.text, self.vocabulary, self.codes = docs, text, vocabulary, codes
        self.tokens, self.words, self.depth = tokens, words, depth
        self.min_count, self.min_next, self.divergence = min_count, min_next, divergence
        self.filter_bits = filter_bits
        self.beside: DataFrame | None = None

    def __getstate__(self):
        tables = ("docs", "vocabulary", "beside", "states", "grams", "ends", "state_filter", "gram_filter")
        return {k: v for k, v in self.__dict__.items() if k not in tables} | {"codes": self.codes.nameless()}

    def rows(self) -> DataFrame:
        """The counted rows of all parts and what stands beside them."""
        counted = count_rows(self.docs, self.text, self.depth, self.codes)
        return counted.unionByName(self.beside, allowMissingColumns=True)

    def _each(self, told, schema: str) -> DataFrame:
        """Rows that ``told`` makes of the branches of each part."""
        tree = self

        def tell(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            return pa.concat_tables(told(key[0].as_py(), found) for _, found in _branches(table, tree))

        return self.rows().groupBy("part").applyInArrow(tell, schema)

    @cached_property
    def ends(self) -> np.ndarray:
        """The words in several parts that are retained."""
        if not len(self.codes.hot):
            return self.codes.hot

        def told(_: int, found: Branches) -> pa.Table:
            return pa.table({"word": _signed(found.ends)})

        return self._each(told, "word long").distinct().toArrow()["word"].to_numpy().view(np.uint64)

    @cached_property
    def states(self) -> DataFrame:
        """Columns ``key``, ``depth``, ``parent``, ``total``, ``weight`` and ``divergence`` of the retained states."""
        codes, ends = self.codes, self.ends

        def told(part: int, found: Branches) -> pa.Table:
            found.keep(ends)
            out = []
            for d, level in enumerate(found.levels, 1):
                kept = level["kept"]
                if d == 1:
                    # A word in several parts is told by its first one.
                    kept = kept & (codes.first_part(level["contexts"]) == part)
                parent = found.levels[d - 2]["contexts"][level["parent"][kept]] if d > 1 else np.zeros(kept.sum(), np.uint64)
                out.append(pa.table({
                    "key": _signed(level["contexts"][kept]), "depth": pa.array(np.full(kept.sum(), d, np.int32)),
                    "parent": _signed(parent), "total": pa.array(level["total"][kept].astype(np.int64)),
                    "weight": pa.array(level["weight"][kept]), "divergence": pa.array(level["divergence"][kept]),
                }))
            return pa.concat_tables(out)

        return self._each(told, "key long, depth int, parent long, total long, weight double, divergence double")

    @cached_property
    def grams(self) -> DataFrame:
        """Columns ``key``, ``next`` and ``p``: what the retained states hold themselves."""
        codes, ends = self.codes, self.ends

        def told(part: int, found: Branches) -> pa.Table:
            found.keep(ends)
            out = []
            for d, level in enumerate(found.levels, 1):
                own = level["stored"] & level["kept"][level["context"]]
                if d == 1:
                    own &= (codes.first_part(level["contexts"]) == part)[level["context"]]
                key = level["contexts"][level["context"][own]]
                out.append(pa.table({"key": _signed(key), "next": _signed(level["next"][own]), "p": pa.array(level["p"][own])}))
            return pa.concat_tables(out)

        return self._each(told, "key long, next long, p double")

    def _filter(self, keys: DataFrame) -> np.ndarray | None:
        """A filter of keys, or none where they would set most of the bits."""
        return key_filter(keys, self.filter_bits) if keys.count() <= 1 << (self.filter_bits - 1) else None

    @cached_property
    def state_filter(self) -> np.ndarray | None:
        return self._filter(self.states.select("key"))

    @cached_property
    def gram_filter(self) -> np.ndarray | None:
        return self._filter(self.grams.select(F.xxhash64("key", "next").alias("key")))


#: Spark removes what a query shuffled when the query ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame) -> DataFrame:
    """The rows from the shared folder; what was shuffled to make them is removed, as nothing else reads it."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, None)
    conf.set(CLEAN_UP, "true")
    try:
        return materialize(df)
    finally:
        conf.unset(CLEAN_UP) if before is None else conf.set(CLEAN_UP, before)


def learn(
    docs: DataFrame,
    text: str = "text",
    max_depth: int = MAX_DEPTH,
    min_count: int = MIN_COUNT,
    min_share: float = MIN_SHARE,
    min_next: int = MIN_NEXT,
    divergence: float = DIVERGENCE,
    filter_bits: int = FILTER_BITS,
) -> Tree:
    """The tree of the given documents; null texts are empty ones.

    With ``min_count`` and ``min_next`` of 1 and no share, every context up to ``max_depth`` and every symbol behind it counts.
    """
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = _written(count_words(docs, text))
    ends = F.max(F.when(F.col("word") == F.lit(END), F.col("n")))
    sums = vocabulary.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("words"), F.coalesce(ends, F.lit(0)).alias("ends")
    ).first()
    tokens, words = sums["tokens"], sums["words"]
    min_count = max(min_count, math.ceil(min_share * tokens))
    # The counts that common words have: as low as the number of words allows.
    of_count = vocabulary.groupBy("n").count().toArrow().sort_by([("n", "descending")])
    least = of_count["n"].to_numpy()[np.cumsum(of_count["count"].to_numpy()) <= COMMON]
    common = vocabulary.where((F.col("word") != F.lit(END)) & (F.col("n") >= int(least[-1] if len(least) else tokens + 1)))
    codes = Codes(common.select(F.xxhash64("word").alias("key"), "n").toArrow(), sums["ends"], tokens)
    tree = Tree(docs, text, vocabulary, codes, tokens, words, max_depth, min_count, min_next, divergence, filter_bits)
    tree.beside = _written(beside(docs, text, vocabulary, max_depth, codes))
    return tree


# Scoring ---------------------------------------------------------------------


def deal(docs: DataFrame, tree: Tree) -> DataFrame:
    """Columns ``part``, ``block`` and ``places``: the packed places of a block in each part, and which texts were learned.

    Other rows hold a text of a block: ``text``, ``doc_id``, ``n_tokens``, ``n_known`` and ``base_score`` without its rare words, or
    a rare ``word`` of it, ``n_tokens`` times.
    """
    codes, depth, tokens, words = tree.codes, tree.depth, tree.tokens, tree.words

    def told(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, texts, learned = (table[c].chunk(0) for c in ("doc_id", "text", "learned"))
        found = Places(texts, codes)
        rows, text = found.rows(depth)
        learned = learned.to_numpy(zero_copy_only=False)
        per_part = [(p, pack_places(rows[:, at], text[at], learned)) for p, at in _by_part(rows, codes, text)]
        rare = found.symbols >= RARE
        code = np.where(rare, 0, found.symbols).astype(np.int64)
        known = np.add.reduceat((~rare).astype(np.int64) & (codes.counts[code] > 0), found.starts)
        single = np.log10((codes.counts[code] + 0.5) / (tokens + 0.5 * (words + 1)))
        base = np.add.reduceat(np.where(rare, 0.0, single), found.starts)
        pairs = found.text[rare] * (len(found.words) + 1) + found.at[rare]
        pairs, times = np.unique(pairs, return_counts=True)
        in_text, which = np.divmod(pairs, len(found.words) + 1)
        word = pa.array(found.words[which].tolist(), pa.binary())
        sizes = len(per_part), len(ids), len(word)

        def column(kind, *pieces):
            pieces = [pa.nulls(n, kind) if x is None else x.cast(kind) for x, n in zip(pieces, sizes)]
            return pa.concat_arrays(pieces)

        part = pa.array(np.full(len(ids), block % codes.parts)), pa.array(np.full(len(word), block % codes.parts))
        return pa.record_batch(
            [
                column(pa.int32(), pa.array([p for p, _ in per_part], pa.int32()), *part),
                pa.array(np.full(sum(sizes), block)),
                column(pa.binary(), pa.array([x for _, x in per_part], pa.binary()), None, None),
                column(pa.int32(), None, pa.array(np.arange(len(ids))), pa.array(in_text)),
                column(pa.int64(), None, ids, None),
                column(pa.int64(), None, pa.array(found.sizes), pa.array(times)),
                column(pa.int64(), None, pa.array(known), None),
                column(pa.float64(), None, pa.array(base), None),
                column(pa.binary(), None, None, word),
            ],
            ["part", "block", "places", "text", "doc_id", "n_tokens", "n_known", "base_score", "word"],
        )

    def run(batches):
        number, held, size = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if number is None:
                number = batch.column(0)[0].as_py() << 32
            held.append(batch)
            size += batch.column(1).nbytes
            if size >= BLOCK_BYTES:
                yield told(number, held)
                number, held, size = number + 1, [], 0
        if held:
            yield told(number, held)

    schema = "part int, block long, places binary, text int, doc_id long, n_tokens long, n_known long, base_score double, word binary"
    return docs.mapInArrow(run, schema)


def score(
    docs: DataFrame, tree: Tree, doc_id: str = "doc_id", text: str = "text", learned: Column | None = None
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score``.

    ``score`` is the log10 probability of the text and its end under the tree, ``base_score`` that under single words.
    Null, empty and blank texts have the end alone. Rows are taken one by one, repeated ones too.
    Where the documents that the tree was learned from are all among these, ``learned`` can tell which they are; their places
    then go to the parts once, to be counted and scored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.spark_partition_id().alias("part"), F.col(text).cast("binary").alias("text"), F.col(doc_id).cast("long").alias("doc_id"),
        (F.lit(False) if learned is None else F.coalesce(learned, F.lit(False))).alias("learned"),
    )
    kept = ["block", "gains", "text", "doc_id", "n_tokens", "n_known", "base_score", "word"]
    schema = "block long, gains binary, text int, doc_id long, n_tokens long, n_known long, base_score double, word binary"

    def compute(table: pa.Table) -> pa.Table:
        other = table.filter(pc.is_valid(table["text"]))
        other = other.append_column("gains", pa.nulls(len(other), pa.binary())).select(kept)
        asked = table.filter(pc.is_valid(table["places"]))
        blocks = asked["block"].to_pylist()
        if not blocks:
            return other
        places, at, learned = zip(*(unpack_places(x.as_py(), tree.depth + 1) for x in asked["places"]))
        size = sum(map(len, at))
        rows = np.concatenate(places, axis=1)
        del places
        branches = _branches(table, tree, rows, np.concatenate([flags[text] for text, flags in zip(at, learned)]))
        del rows
        out = []

        def told(gains: np.ndarray, word: int | None):
            """The sums of every text. Those that hold only if another part retains a word name it."""
            start = 0
            for block, text, flags in zip(blocks, at, learned):
                each = np.bincount(text, gains[start : start + len(text)], len(flags))
                start += len(text)
                if word is None or each.any():
                    out.append((block, pa.compress(each.tobytes(), codec="zstd", asbytes=True), word))

        plain, more, ends, nearest = np.zeros(size), {}, [], None
        for which, found in branches:
            # Places to be scored are the last ones.
            mine = np.searchsorted(which, found.all - size)
            own = which[mine:] - (found.all - size)
            plain[own] = found.gains(len(own))
            ends += found.ends.tolist()
            if len(found.open):
                nearest = found.nearest[mine:]
                found.keep(found.open)
                less = found.gains(len(own)) - plain[own]
                for word in found.open.tolist():
                    there = nearest == word
                    more[word] = own[there], less[there]
        told(plain, None)
        for word, (own, less) in more.items():
            each = np.zeros(size)
            each[own] = less
            told(each, word)
        block, gains, word = zip(*out, *((None, None, word) for word in ends))
        summed = {"block": pa.array(block, pa.int64()), "gains": pa.array(gains, pa.binary()), "doc_id": pa.array(word, pa.int64())}
        return pa.concat_tables([other, pa.table(summed)], promote_options="default")

    dealt = deal(rows, tree).unionByName(tree.rows() if learned is None else tree.beside, allowMissingColumns=True)
    if learned is not None:
        dealt = dealt.withColumn("packed", F.lit(None).cast("binary"))
    # Read more than once below.
    found = _written(dealt.groupBy("part").applyInArrow(compute, schema))
    texts = found.where(F.col("text").isNotNull() & F.col("word").isNull())
    rare = found.where(F.col("word").isNotNull()).join(tree.vocabulary, "word", "left")
    seen = F.coalesce("n", F.lit(0))
    rare = rare.select(
        "block", "text",
        F.when(seen > 0, F.col("n_tokens")).otherwise(0).alias("n_known"),
        (F.col("n_tokens") * F.log10((seen + 0.5) / (tree.tokens + 0.5 * (tree.words + 1)))).alias("base_score"),
    )

    def add_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sums = 0.0
        for packed, n in zip(table["gains"], table["texts"].to_pylist()):
            sums = sums + np.frombuffer(pa.decompress(packed.as_py(), 8 * n, codec="zstd", asbytes=True))
        numbers = np.arange(len(sums), dtype=np.int32)
        return pa.table({"block": pa.array(np.full(len(sums), key[0].as_py())), "text": pa.array(numbers), "gain": pa.array(sums)})

    sizes = texts.groupBy("block").agg(F.count("*").alias("texts"))
    gained = found.where(F.col("gains").isNotNull())
    if len(tree.codes.hot):
        ends = found.where(F.col("block").isNull()).select("doc_id").distinct()
        gained = gained.where(F.col("doc_id").isNull()).unionByName(gained.join(F.broadcast(ends), "doc_id", "left_semi"))
    gained = gained.select("block", "gains").join(sizes, "block")
    gained = gained.groupBy("block").applyInArrow(add_up, "block long, text int, gain double")
    whole = texts.select("block", "text", "doc_id", "n_tokens", "n_known", "base_score")
    whole = whole.unionByName(rare, allowMissingColumns=True).unionByName(gained, allowMissingColumns=True)
    whole = whole.groupBy("block", "text").agg(
        F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score")),
        F.coalesce(F.sum("gain"), F.lit(0.0)).alias("gain"),
    )
    return whole.select("doc_id", "n_tokens", "n_known", "base_score", (F.col("base_score") + F.col("gain")).alias("score"))


def held_out(doc_id: Column) -> Column:
    """A fifth of the ids is never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document under the tree learned from four fifths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = ~held_out(F.col("doc_id"))
    tree = learn(docs.where(learned))
    return score(docs, tree, learned=learned).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tree.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
