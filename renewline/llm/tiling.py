"""Benchmark decontamination by greedy string tiling.

Documents and test items are split into lower-case words; in scripts written without
spaces every character is a word. Items that share a run of ``min_match`` words with a
document are its candidates; items shorter than that must be found as a whole. A candidate whose shared runs
could cover the threshold is tiled: search for common runs of a length by Karp-Rabin
hashes, mark the longest that overlap nothing marked, halve the length, repeat down to
``min_match``. Coverage is the share of an item's words under tiles, so a passage whose
sentences were reordered is found as well.

The items go to the tasks in blocks of bounded size, so documents are not shuffled; a
benchmark beyond one block takes one pass over the documents per block, and the driver
holds one block at a time.

Null texts and texts without words match nothing, on either side.
Repeated documents are reported once per row, repeated items once.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewline.llm.common import map_batches, materialize, small_batches

#: Words a common run must have.
MIN_MATCH = 5
#: Share of an item's words under tiles from which it counts as leaked.
THRESHOLD = 0.5
#: Characters of items sent to every task at once.
BLOCK_CHARS = 16_000_000

#: Scripts written without spaces: Thai, Lao, Myanmar, Khmer, Tai, Balinese and Javanese, kana, bopomofo, Yi, Han.
_UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u1b00-\u1b7f\u3005-\u3007\u3040-\u312f"
    "\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\ua4cf\ua980-\ua9df\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f"
    "\U0001b000-\U0001b16f\U00020000-\U0003ffff"
)
_SINGLE = re.compile(f"[{_UNSPACED}]")
_PLAIN = re.compile(r"\w+")
_WORD = re.compile(rf"(?=[{_UNSPACED}])\w|[^\W{_UNSPACED}]+")
_BASE = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[str]:
    if not text:
        return []
    return (_WORD if _SINGLE.search(text) else _PLAIN).findall(text.lower())


def _hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes, modulo 2**64, of all runs of ``length`` ids."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    done = 0
    # Runs of a power of two are combined from halves; the bits of length pick them.
    part, size, base = ids.astype(np.uint64), 1, _BASE
    while True:
        if length & size:
            out = out * np.uint64(base) + part[done : done + n]
            done += size
        size *= 2
        if size > length:
            return out
        part = part[: len(part) - size // 2] * np.uint64(base) + part[size // 2 :]
        base = base * base % (1 << 64)


def _clear(blocked: np.ndarray, length: int) -> np.ndarray:
    """Whether no position of a run of ``length`` is blocked, for each start."""
    sums = np.concatenate(([0], np.cumsum(blocked)))
    return sums[length:] == sums[: len(sums) - length]


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (item start, document start, length); ids of 0 match nothing."""
    item_used, doc_used = item == 0, doc == 0
    out: list[tuple[int, int, int]] = []
    length = max(min_match, len(item))
    while len(item) >= min_match:
        found = _scan(item, doc, item_used, doc_used, length)
        while found:
            found.sort(key=lambda t: (-t[2], t[0], t[1]))
            rest = []
            for i, j, n in found:
                free = ~(item_used[i : i + n] | doc_used[j : j + n])
                if free.all():
                    item_used[i : i + n] = True
                    doc_used[j : j + n] = True
                    out.append((i, j, n))
                    continue
                # Marked meanwhile: its free stretches compete again by their own length.
                edges = np.flatnonzero(np.diff(np.concatenate(([0], free.astype(np.int8), [0]))))
                rest += [(i + a, j + a, b - a) for a, b in zip(edges[::2], edges[1::2]) if b - a >= length]
            found = rest
        if length == min_match or item_used.all():
            break
        length = max(min_match, length // 2)
    return out


def _scan(item, doc, item_used, doc_used, length: int) -> list[tuple[int, int, int]]:
    """Maximal unmarked common runs of at least ``length`` words."""
    if len(item) < length or len(doc) < length:
        return []
    starts = np.flatnonzero(_clear(item_used, length))
    places = np.flatnonzero(_clear(doc_used, length))
    if not len(starts) or not len(places):
        return []
    wanted, there = _hashes(item, length)[starts], _hashes(doc, length)[places]
    order = np.argsort(wanted, kind="stable")
    wanted, starts = wanted[order], starts[order]
    lo, hi = np.searchsorted(wanted, there), np.searchsorted(wanted, there, side="right")
    out = []
    for at in np.flatnonzero(hi > lo).tolist():
        j = int(places[at])
        for i in starts[lo[at] : hi[at]].tolist():
            before = i and j and not item_used[i - 1] and not doc_used[j - 1]
            if before and item[i - 1] == doc[j - 1]:
                continue
            n = min(len(item) - i, len(doc) - j)
            same = (item[i : i + n] == doc[j : j + n]) & ~item_used[i : i + n] & ~doc_used[j : j + n]
            stop = n if same.all() else int(same.argmin())
            if stop >= length:
                out.append((i, j, stop))
    return out


class Items:
    """A block of test items with an index of their runs of ``min_match`` words.

    Items of fewer words are indexed whole, by their length.
    """

    def __init__(self, rows: list[tuple[int | None, str | None]], min_match: int = MIN_MATCH):
        self.min_match = min_match
        self.vocabulary: dict[str, int] = {}
        self.ids: list[int | None] = []
        self.words: list[np.ndarray] = []
        for item_id, text in rows:
            found = words(text)
            if found:
                numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found]
                self.ids.append(item_id)
                self.words.append(np.array(numbers, np.int64))
        runs = np.array([min(min_match, len(w)) for w in self.words], np.int64)
        self.index = {int(n): self._index(n, np.flatnonzero(runs == n)) for n in np.unique(runs)}

    def _index(self, length: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all runs of ``length`` words of the given items in order, with item and place of each."""
        hashes = [_hashes(self.words[i], length) for i in which]
        sizes = [len(h) for h in hashes]
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        place = np.concatenate([np.arange(n) for n in sizes])
        return every[order], np.repeat(which, sizes)[order], place[order]

    def number(self, text: str | None) -> np.ndarray:
        """Word numbers of a text; 0 for words that no item has."""
        found = words(text)
        known = self.vocabulary.get
        return np.fromiter((known(w, 0) for w in found), np.int64, len(found))

    def candidates(self, doc: np.ndarray, threshold: float) -> list[int]:
        """Items whose runs shared with the document could cover the threshold."""
        return sorted(i for length in self.index for i in self._candidates(doc, length, threshold))

    def _candidates(self, doc: np.ndarray, length: int, threshold: float) -> list[int]:
        hashes, items, places = self.index[length]
        clear = np.flatnonzero(_clear(doc == 0, length)) if len(doc) >= length else []
        if not len(clear):
            return []
        seeds = np.unique(_hashes(doc, length)[clear])
        lo, hi = np.searchsorted(hashes, seeds), np.searchsorted(hashes, seeds, side="right")
        n = hi - lo
        if not n.any():
            return []
        rows = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        item, place = items[rows], places[rows]
        order = np.lexsort((place, item))
        item, place = item[order], place[order]
        # Words under the union of the shared runs, per item.
        step = np.full(len(item), length)
        same = item[1:] == item[:-1]
        step[:-1][same] = np.minimum(length, np.diff(place)[same])
        most = np.bincount(item, weights=step, minlength=len(self.words))
        return [i for i in np.unique(item).tolist() if most[i] >= threshold * len(self.words[i])]

    def leaks(self, text: str | None, threshold: float) -> list[tuple[int, int, int]]:
        """(item, words under tiles, tiles) of every item that reaches the threshold."""
        doc = self.number(text)
        out = []
        for i in self.candidates(doc, threshold):
            found = tiles(self.words[i], doc, min(self.min_match, len(self.words[i])))
            covered = sum(n for _, _, n in found)
            if found and covered >= threshold * len(self.words[i]):
                out.append((i, covered, len(found)))
        return out


class Blocks:
    """The items in blocks of bounded size, each collected when it is its turn."""

    def __init__(self, rows: DataFrame, count: int, min_match: int):
        self.rows, self.count, self.min_match = rows, count, min_match

    def __len__(self) -> int:
        return self.count

    def __iter__(self):
        for n in range(self.count):
            yield self._collect(n)

    def _collect(self, n: int) -> Items:
        block = F.pmod(F.xxhash64("text"), F.lit(self.count))
        found = [tuple(r) for r in self.rows.where(block == n).collect()]
        return Items(sorted(found, key=lambda r: (r[0] is None, r)), self.min_match)


def item_blocks(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
    min_match: int = MIN_MATCH, block_chars: int = BLOCK_CHARS,
) -> Blocks:
    """The items in as many blocks as their total size needs, at least one."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.where("text is not null").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    return Blocks(rows, max(1, -(-total // block_chars)), min_match)


def find_leaks(
    docs: DataFrame, blocks: Blocks, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document and leaked item: ids, words of the item, words covered, tiles, coverage."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def search(items: Items):
        def run(batches):
            for batch in batches:
                out = []
                for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for i, covered, count in items.leaks(value, threshold):
                        n = len(items.words[i])
                        out.append((key, items.ids[i], n, covered, count, covered / n))
                columns = list(zip(*out)) or [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=LEAK_COLUMNS)

        return run

    schema = "doc_id long, item_id long, item_words long, matched_words long, n_tiles long, coverage double"
    out = None
    for items in blocks:
        found = rows.mapInArrow(search(items), schema)
        if len(blocks) > 1:
            found = materialize(found)
        out = found if out is None else out.unionByName(found)
        # Let go before the next block is collected.
        del items
    return out


LEAK_COLUMNS = ["doc_id", "item_id", "item_words", "matched_words", "n_tiles", "coverage"]


def drop_leaked(docs: DataFrame, blocks: Blocks, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows in which no item reaches the threshold, all columns unchanged."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def clean(items: Items):
        def change(batch):
            kept = [not items.leaks(value, threshold) for value in batch.column(at).to_pylist()]
            return batch.filter(pa.array(kept, pa.bool_()))

        return change

    for items in blocks:
        docs = map_batches(docs, clean(items))
        if len(blocks) > 1:
            docs = materialize(docs)
        del items
    return docs


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of which it holds at least the threshold."""
    blocks = item_blocks(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), blocks)
