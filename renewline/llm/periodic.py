"""Periodic runs of words by recompression.

The words of a batch of texts stand in one sequence, texts parted by symbols that occur
once, and are compressed in turns: every block of equal neighbours becomes one symbol
(block compression), then the alphabet is split into left and right symbols and every
neighbouring left and right one become one symbol (pair compression). The rules form a
run-length grammar: a level's sequence, and where each symbol's part begins one level below.
Compression ends when no symbol occurs twice.

Equal stretches are compressed alike but for their borders, so the longest common
extension (LCE) of two positions is read from the grammar: equal symbols are walked over and
levels climbed until two symbols differ, then their parts are compared level by level down
to the words. That takes a few steps a level, whatever the length, and all queries of a
batch take them together. Queries to the left use the same grammar mirrored.

A run of period q with at least ``copies`` periods holds two neighbouring points of the
grid of step (copies - 1) q, q apart: candidates for all periods are a harmonic sum, n log n
in a text of n words. Two LCE queries extend a candidate exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renewline.llm.common import small_batches

MIN_LENGTH = 6
COPIES = 4
#: Candidates extended at once, first and at most: short periods go first, as their runs settle longer ones.
FIRST_CANDIDATES = 1 << 16
CANDIDATES = 1 << 20


class Level:
    """A sequence of symbols, and the parts of which the next level's symbols consist."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray | None, blocks: bool):
        self.symbols, self.first, self.blocks = symbols, first, blocks
        self.parent = None
        if first is not None:
            opens = np.zeros(len(symbols), np.int32)
            opens[first[:-1]] = 1
            self.parent = np.cumsum(opens, dtype=np.int32) - 1

    def mirrored(self) -> Level:
        """The same level read from the right."""
        first = None if self.first is None else (len(self.symbols) - self.first)[::-1].copy()
        return Level(self.symbols[::-1].copy(), first, self.blocks)


def _named(keys: np.ndarray, next_name: int) -> tuple[np.ndarray, int]:
    """One new name for each distinct key."""
    distinct, names = np.unique(keys, return_inverse=True)
    return (names + next_name).astype(np.int32), next_name + len(distinct)


def _block_starts(symbols: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))


def _pair_starts(symbols: np.ndarray, turn: int) -> np.ndarray:
    """Where parts begin when each left symbol takes the right symbol behind it.

    The side of a symbol is a bit of its mixed name; of the two ways round, the one with more pairs is taken.
    """
    salt = np.uint64(turn * 0xD1B54A32D192ED03 % (1 << 64))
    mixed = symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    right = (mixed >> np.uint64(63)).astype(bool)
    ahead, behind = ~right[:-1] & right[1:], right[:-1] & ~right[1:]
    taken = ahead if ahead.sum() >= behind.sum() else behind
    return np.flatnonzero(np.concatenate(([True], ~taken)))


def grammar(symbols: np.ndarray) -> list[Level]:
    """The levels from the words up to a sequence in which no symbol occurs twice.

    The first and the last symbol must occur nowhere else.
    """
    levels = []
    symbols = symbols.astype(np.int32)
    next_name = int(symbols.max()) + 1
    turn = 0
    while np.bincount(symbols).max() > 1:
        blocks = turn % 2 == 0
        starts = _block_starts(symbols) if blocks else _pair_starts(symbols, turn)
        turn += 1
        if len(starts) == len(symbols):
            continue
        first = np.concatenate((starts, [len(symbols)])).astype(np.int32)
        size = np.diff(first)
        longer = size > 1
        # A part of one symbol keeps its name.
        above = symbols[starts]
        with_ = size[longer] if blocks else symbols[starts[longer] + 1]
        keys = above[longer].astype(np.int64) * (np.int64(with_.max()) + 1) + with_
        above = above.copy()
        above[longer], next_name = _named(keys, next_name)
        levels.append(Level(symbols, first, blocks))
        symbols = above
    return [*levels, Level(symbols, None, False)]


def common_extension(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols agree from each x and y on, for x other than y."""
    length = np.zeros(len(x), np.int64)
    origin = x
    at = (np.arange(len(x)), x.astype(np.int64), y.astype(np.int64))
    stopped: list[list[tuple[np.ndarray, ...]]] = [[] for _ in levels]
    for k, level in enumerate(levels):
        ids, x, y = at
        if not len(ids):
            break
        same = level.symbols[x] == level.symbols[y]
        stopped[k].append((ids[~same], x[~same], y[~same]))
        ids, x, y = ids[same], x[same], y[same]
        if level.parent is None or not len(ids):
            break
        first, px, py = level.first, level.parent[x], level.parent[y]
        aligned = (first[px] == x) & (first[py] == y)
        if level.blocks:
            # Within blocks of one symbol: the shorter rest decides.
            rest_x, rest_y = first[px + 1] - x, first[py + 1] - y
            step = np.where(aligned, 0, np.minimum(rest_x, rest_y))
            x, y = x + step, y + step
            ends = ~aligned & (rest_x != rest_y)
            stopped[k].append((ids[ends], x[ends], y[ends]))
            ids, x, y = ids[~ends], x[~ends], y[~ends]
        else:
            # A right symbol ends its part on both sides.
            x, y = x + ~aligned, y + ~aligned
        at = (ids, level.parent[x].astype(np.int64), level.parent[y].astype(np.int64))
    at = tuple(np.zeros(0, np.int64) for _ in range(3))
    for k in range(len(levels) - 1, -1, -1):
        ids, x, y = at = tuple(np.concatenate(c) for c in zip(at, *stopped[k]))
        if k == 0:
            length[ids] = x - origin[ids]
        elif len(ids):
            below = levels[k - 1]
            to_x, to_y = below.first[x + 1], below.first[y + 1]
            x, y = below.first[x].astype(np.int64), below.first[y].astype(np.int64)
            same = below.symbols[x] == below.symbols[y]
            step = same * (np.minimum(to_x - x, to_y - y) if below.blocks else 1)
            at = (ids, x + step, y + step)
    return length


def find_runs(
    words: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH, copies: int = COPIES
) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``words`` holds the numbered words of all texts one after the other, ``sizes`` how many each has.
    """
    n_texts, next_name = len(sizes), int(words.max(initial=0)) + 1
    # Text i begins behind parting symbol i; the last one ends the sequence.
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1] + 1
    whole = np.empty(len(words) + n_texts + 1, np.int64)
    parting = np.concatenate((begin - 1, [len(whole) - 1]))
    whole[parting] = next_name + np.arange(n_texts + 1)
    inside = np.ones(len(whole), bool)
    inside[parting] = False
    whole[inside] = words

    # One entry for each text and period, shortest periods first.
    periods = sizes // copies
    text = np.repeat(np.arange(n_texts), periods)
    q = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    order = np.argsort(q, kind="stable")
    text, q = text[order], q[order]
    step = (copies - 1) * q
    points = -(-(sizes[text] - q) // step)
    upto = np.cumsum(points)

    levels = mirrored = None
    covered, cover_end = np.zeros(len(whole), np.int64), np.zeros(len(whole), np.int64)
    found = []
    low, at_once = 0, FIRST_CANDIDATES
    while low < len(text):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + at_once, "right")))
        at_once = min(2 * at_once, CANDIDATES)
        many = points[low:high]
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        period = np.repeat(q[low:high], many)
        i = np.repeat(begin[text[low:high]], many) + nth * np.repeat(step[low:high], many)
        low = high
        # Within a run already found, a multiple of its period gives that run again.
        known = (covered[i] > 0) & (i + period < cover_end[i]) & (period % np.maximum(covered[i], 1) == 0)
        hit = (whole[i] == whole[i + period]) & ~known
        i, period = i[hit], period[hit]
        if not len(i):
            continue
        if levels is None:
            levels = grammar(whole)
            mirrored = [level.mirrored() for level in levels]
        right = common_extension(levels, i, i + period)
        last = len(whole)
        left = common_extension(mirrored, last - i, last - i - period)
        length = left + period + right
        long = length >= np.maximum(min_length, copies * period)
        if not long.any():
            continue
        rows = np.unique(np.stack((i - left, length, period), axis=1)[long], axis=0)
        found.append(rows)
        for start, size, p in rows.tolist():
            covered[start : start + size] = p
            cover_end[start : start + size] = start + size
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    rows = np.concatenate(found)
    # The same stretch under several periods: the smallest is its period.
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    smallest = np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
    rows = rows[smallest]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    text = np.searchsorted(begin, rows[:, 0], "right") - 1
    return text, rows[:, 0] - begin[text], rows[:, 1], rows[:, 2]


def _numbered(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words, their numbers and how many each text has."""
    split = [t.split() if t else [] for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    every = [w for words in split for w in words]
    names = {w: i for i, w in enumerate(dict.fromkeys(every))}
    return every, np.fromiter(map(names.__getitem__, every), np.int64, len(every)), sizes


def periodic_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    copies: int = COPIES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``runs`` and ``collapsed``.

    A run is a stretch of words with smallest period q, of at least ``min_length`` words
    and ``copies`` periods (2 or more), that no neighbouring word extends. ``runs`` lists
    (start, length, period) by start, then period; ``collapsed`` is the text, words joined
    by one space, without the words that stand in a run behind its first period.

    Words are parted by ASCII white space; a null, empty or blank text has none. Rows
    are taken one by one, so repeated rows give repeated results, and null ids stay null.
    """
    if copies < 2:
        raise ValueError("a run has at least two periods")
    small_batches(docs.sparkSession)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def compute(batches):
        for batch in batches:
            words, numbers, sizes = _numbered(batch.column(1).to_pylist())
            at, start, length, period = find_runs(numbers, sizes, min_length, copies)
            begin = np.cumsum(sizes) - sizes
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, begin[at] + start + period, 1)
            np.add.at(change, begin[at] + start + length, -1)
            keep = np.cumsum(change)[:-1] == 0
            out = []
            for low, high in zip(begin.tolist(), (begin + sizes).tolist()):
                kept = keep[low:high]
                own = words[low:high]
                out.append(b" ".join(own if kept.all() else [w for w, k in zip(own, kept.tolist()) if k]))
            offsets = np.searchsorted(at, np.arange(len(sizes) + 1)).astype(np.int32)
            listed = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(run))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(offsets), listed),
                    pa.array(out, pa.binary()).view(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(
        compute,
        "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where a tenth of the documents repeats its words from some place on.

    With h the CRC-32 of the id and g = h / 10: where 10 divides h, word i from a = g % n on
    becomes word a + (i - a) % p, with p = 1 + (n - a) / (3 + g % 8) and n the words.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n, a = F.size("w"), (F.col("g") % F.size("w")).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    again = F.ceil((n - a) / p).cast("int")
    planted = F.slice(
        F.concat(F.slice("w", F.lit(1), a), F.flatten(F.array_repeat(F.slice("w", a + 1, p), again))), F.lit(1), n
    )
    return chosen.select(
        "doc_id", F.when(F.size("w") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text")
    )


def _digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document's words, after some were planted, and the collapsed text."""
    found = periodic_runs(with_planted_runs(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    # Greatest length, then smallest start, then smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"])))
    found = found.withColumn("best", F.when(F.size("runs") > 0, best))
    start, length, period = -F.col("best.col2"), F.col("best.length"), -F.col("best.col3")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        _digest(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))).alias("runs_sha256"),
        _digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
