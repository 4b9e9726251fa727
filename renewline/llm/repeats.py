"""Removal of repeated byte strings by bucket-pointer refinement.

Positions of all texts are sorted into buckets of equal q-grams; buckets are refined by
sorting on the bucket identifiers of later offsets, each length reusing the identifiers
of the one before, until they stand for strings of the wanted length. A bucket with one
position is final and goes at once.

An identifier is a 64-bit name made from the content: the first 8 bytes are their own
name, and the name of a longer string is a mix of the names of its two halves, one of
them at the later offset. Equal strings so have equal names in every task, and sorting
on (bucket, bucket at the later offset) needs no renumbering between tasks.

Sorting all positions would move many times the input. So the first sort takes, of each
string of the wanted length, only its smallest bucket of half that length: neighbouring
strings share it, and a run of them is one row. Equal strings have the same smallest
bucket, so they meet there.

1. A run alone in its bucket holds no repeated string. (A run that meets itself, as in
   periodic text, is flagged when it is made and goes on.)
2. If all runs of a bucket have the same content, all their strings are repeated.
3. The rest is refined: runs of equal content become one, and the strings of each are
   sorted on (bucket, bucket of full length). The names of a run move as one list, unless
   its bucket has many runs; then every position moves on its own.

A bucket of any size only meets aggregations with map-side combining and joins whose
row side can be split. The two names a match is judged by have 128 bits together.

A null text counts as empty; matches never cross documents; texts shorter than the
wanted length keep all bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from renewline.llm.common import materialize, small_batches

#: Bytes of a repeated string.
LENGTH = 400
#: Runs of a bucket up to which its strings are compared in one task. Beyond that, they
#: are counted map-side and looked up by their names, whatever the number.
TOGETHER = 1_000
#: Bytes that are named at once; longer texts are cut into overlapping pieces.
BLOCK = 1 << 18
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S1, _S2 = np.uint64(32), np.uint64(29)
_GRAM = 8


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of pairs, order matters."""
    out = a >> _S1
    out ^= a
    out *= _K1
    out += b
    out ^= out >> _S2
    out *= _K2
    out ^= out >> _S1
    return out


def names(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all strings of half the length (rounded up) and of the whole length."""
    half = (length + 1) // 2
    now = data.astype(np.uint64)
    size = 1
    while size < _GRAM:
        # Up to 8 bytes a string is its own name.
        now = now[:-size] | now[size:] << np.uint64(8 * size)
        size *= 2
    while size < half:
        later = min(size, half - size)
        now = _mix(now[: len(now) - later], now[later:])
        size += later
    later = length - half
    return now, _mix(now[: len(now) - later], now[later:])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, from block-wise running minima."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _pieces(texts: list[bytes], length: int):
    """Groups of (text, offset, bytes) of bounded total size; pieces overlap by length - 1."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, BLOCK):
            piece = text[at : at + BLOCK + length - 1]
            group.append((i, at, piece))
            size += len(piece)
            if size >= BLOCK:
                yield group
                group, size = [], 0
    if group:
        yield group


def runs(texts: list[bytes], length: int = LENGTH):
    """Per group of pieces: text, first start, number of strings, bucket, content name, flag."""
    half = (length + 1) // 2
    for group in _pieces(texts, length):
        data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        sizes = np.array([len(p) for _, _, p in group])
        ends = np.cumsum(sizes)
        short, full = names(data, length)
        least = sliding_min(short, length - half + 1)
        piece = np.repeat(np.arange(len(group)), sizes)[: len(least)]
        at = np.flatnonzero(np.arange(len(least)) + length <= ends[piece])
        bucket, piece = least[at], piece[at]
        same = (bucket[1:] == bucket[:-1]) & (piece[1:] == piece[:-1])
        first = np.concatenate(([0], np.flatnonzero(~same) + 1))
        last = np.concatenate((first[1:] - 1, [len(at) - 1]))
        # The smallest bucket leaves the window and yet stays smallest: it occurs again.
        again = short[at] == bucket
        again[:-1] &= same
        again[-1] = False
        flag = np.logical_or.reduceat(again, first)
        lo, hi = at[first], at[last]
        content = _mix(full[lo], full[hi]) + (hi - lo).astype(np.uint64)
        for k in np.flatnonzero(hi - lo > length).tolist():
            # Two strings no longer cover the run: chain enough of them.
            for between in full[lo[k] + length : hi[k] : length]:
                content[k : k + 1] = _mix(content[k : k + 1], between.reshape(1))
        piece = piece[first]
        text = np.array([i for i, _, _ in group])[piece]
        start = lo - (ends - sizes)[piece] + np.array([o for _, o, _ in group])[piece]
        yield text, start, hi - lo + 1, bucket[first], content, flag


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, the text, and two key columns that only rows equal in both share."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return named.withColumns(
        {
            "k1": F.coalesce("doc_id", F.lit(0).cast("long")),
            "k2": F.xxhash64("text", F.col("doc_id").isNull()),
        }
    )


_RUNS = "k1 long, k2 long, start int, n int, bucket long, content long, flag boolean"


def _all_runs(keyed: DataFrame, length: int) -> DataFrame:
    def make(batches):
        for batch in batches:
            for text, start, n, bucket, content, flag in runs(_bytes(batch.column(2)), length):
                rows = pa.array(text)
                columns = [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(start.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    _long(bucket),
                    _long(content),
                    pa.array(flag),
                ]
                yield pa.record_batch(columns, names=["k1", "k2", "start", "n", "bucket", "content", "flag"])

    return keyed.select("k1", "k2", "text").mapInArrow(make, _RUNS)


def _marks(keyed: DataFrame, length: int, together: int) -> DataFrame:
    """Per document key: ``whole``, runs repeated throughout, and ``parts``, runs to refine.

    Of parts with equal content one document's run stands for all; those runs are whole
    already, so only a part that is ``alone`` with its content depends on the outcome.
    """
    found = materialize(_all_runs(keyed, length))
    buckets = found.groupBy("bucket").agg(
        F.count("*").alias("rows"),
        (F.min("content") == F.max("content")).alias("equal"),
        F.max("flag").alias("self"),
    )
    buckets = materialize(buckets.where("rows > 1 or self"))
    met = materialize(
        found.join(buckets, "bucket").withColumn("row", F.xxhash64("k1", "k2", "start")).drop("flag", "self")
    )
    whole = met.where("equal and rows > 1")
    mixed = met.where("not equal or rows = 1")
    classes = mixed.groupBy("bucket", "content").agg(
        F.count("*").alias("copies"), F.min("row").alias("chosen")
    )
    classes = materialize(classes)
    mixed = mixed.join(classes, ["bucket", "content"])
    span = F.struct("start", "n")
    part = F.struct(
        "bucket", "start", "n", (F.col("copies") == 1).alias("alone"), (F.col("rows") <= together).alias("together")
    )
    keys = ["k1", "k2"]
    rows = whole.select(*keys, span.alias("whole"), F.lit(None).alias("part")).unionByName(
        mixed.select(
            *keys,
            F.when(F.col("copies") > 1, span).alias("whole"),
            F.when((F.col("copies") == 1) | (F.col("row") == F.col("chosen")), part).alias("part"),
        )
    )
    rows = rows.where("whole is not null or part is not null")
    # Runs of one document, so as many as its length allows.
    return rows.groupBy(*keys).agg(F.collect_set("whole").alias("whole"), F.collect_set("part").alias("parts"))


def _covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of (start, end) spans."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _kept(data: bytes, removed: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, end in removed:
        out.append(data[at:start])
        at = end
    out.append(data[at:])
    return b"".join(out)


_PARTS = "array<struct<bucket:long,start:int,n:int,alone:boolean,together:boolean>>"


def _windows(texts: DataFrame, length: int, together: bool) -> DataFrame:
    """The names of all strings of the parts, in lists: bucket, document key, start, alone, names.

    ``together`` picks the parts of buckets that are compared in one task, or the others.
    """

    def make(batches):
        for batch in batches:
            table = batch.to_pydict()
            pending, size = [], 0
            for k1, k2, text, parts in zip(table["k1"], table["k2"], table["text"], table["parts"]):
                data = text.encode()
                for part in parts:
                    if part["together"] != together:
                        continue
                    # A long run goes in cuts, so that no group is larger than a block.
                    for at in range(part["start"], part["start"] + part["n"], BLOCK):
                        n = min(BLOCK, part["start"] + part["n"] - at)
                        pending.append((part["bucket"], k1, k2, at, part["alone"], n, data[at : at + n + length - 1]))
                        size += n + length
                        if size >= BLOCK:
                            yield _named(pending, length)
                            pending, size = [], 0
            if pending:
                yield _named(pending, length)

    schema = "bucket long, k1 long, k2 long, start int, alone boolean, names array<long>"
    return texts.select("k1", "k2", "text", "parts").mapInArrow(make, schema)


def _named(pending: list[tuple], length: int) -> pa.RecordBatch:
    *columns, n, data = zip(*pending)
    n = np.array(n)
    _, full = names(np.frombuffer(b"".join(data), np.uint8), length)
    begin = np.concatenate(([0], np.cumsum(n + length - 1)[:-1]))
    ends = np.cumsum(n)
    within = np.arange(ends[-1]) - np.repeat(ends - n, n)
    listed = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], ends)).astype(np.int32)), _long(full[np.repeat(begin, n) + within])
    )
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
    arrays = [*(pa.array(c, k) for c, k in zip(columns, kinds)), listed]
    return pa.record_batch(arrays, names=["bucket", "k1", "k2", "start", "alone", "names"])


def _positions(lists: DataFrame) -> DataFrame:
    """One row per string: bucket, name, document key, start, alone."""
    exploded = lists.select("bucket", "k1", "k2", "start", "alone", F.posexplode("names").alias("at", "name"))
    return exploded.select("bucket", "name", "k1", "k2", (F.col("start") + F.col("at")).alias("start"), "alone")


def _repeated_starts(open_: DataFrame, length: int) -> DataFrame:
    """Document key and start of every string of a lone part that occurs elsewhere too."""
    # Buckets of few runs: the lists meet by bucket, and are sorted on the names there.
    near = _positions(_windows(open_, length, True).repartition("bucket"))
    places = F.count("*").over(Window.partitionBy("bucket", "name"))
    near = near.withColumn("places", places).where("places > 1 and alone").select("k1", "k2", "start")
    # Buckets of many: names are counted on the map side, and strings look theirs up.
    far = _positions(_windows(open_, length, False))
    repeated = far.groupBy("bucket", "name").agg(F.count("*").alias("places")).where("places > 1")
    repeated = materialize(repeated.select("bucket", "name"))
    found = far.where("alone").join(repeated, ["bucket", "name"]).select("k1", "k2", "start")
    return near.unionByName(found)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, together: int = TOGETHER
) -> DataFrame:
    """Remove every byte under a string of ``length`` bytes that starts anywhere else too.

    One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` (maximal
    removed runs as start and end in bytes) and ``kept``, the remaining bytes.
    """
    return _removed(docs, doc_id, text, length, together, digest=False)


def _removed(docs: DataFrame, doc_id: str, text: str, length: int, together: int, digest: bool) -> DataFrame:
    small_batches(docs.sparkSession)
    keyed = _keyed(docs, doc_id, text)
    marks = materialize(_marks(keyed, length, together))
    joined = keyed.join(marks, ["k1", "k2"], "left")
    # What depends on no part is settled here, so that its text moves once.
    kept = "kept string" if digest else "kept binary"
    output = f"doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, {kept}"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
    kinds.append(pa.string() if digest else pa.binary())
    columns = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]

    def settled(key, data: bytes, spans: list[tuple[int, int]]) -> tuple:
        removed = _covered(spans)
        rest = _kept(data, removed)
        rest = hashlib.sha256(rest).hexdigest() if digest else rest
        return key, len(data), sum(b - a for a, b in removed), [{"start": a, "end": b} for a, b in removed], rest

    def first(batches):
        more = ["k1", "k2", "text", "whole", "parts"]
        part = [("bucket", pa.int64()), ("start", pa.int32()), ("n", pa.int32())]
        part = pa.struct([*part, ("alone", pa.bool_()), ("together", pa.bool_())])
        run = pa.struct([("start", pa.int32()), ("n", pa.int32())])
        types = [*kinds, pa.int64(), pa.int64(), pa.string(), pa.list_(run), pa.list_(part)]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["parts"]:
                    open_ = [row[c] for c in more]
                    out.append((row["doc_id"], None, None, None, None, *open_))
                else:
                    spans = [(w["start"], w["start"] + w["n"] + length - 1) for w in row["whole"] or ()]
                    done = settled(row["doc_id"], (row["text"] or "").encode(), spans)
                    out.append((*done, row["k1"], row["k2"], None, None, None))
            arrays = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * len(types), types)]
            yield pa.record_batch(arrays, names=[*columns, *more])

    whole = "array<struct<start:int,n:int>>"
    stage = joined.select("doc_id", "text", "k1", "k2", "whole", "parts").mapInArrow(
        first, f"{output}, k1 long, k2 long, text string, whole {whole}, parts {_PARTS}"
    )
    stage = materialize(stage)
    done = stage.where("parts is null").select(*columns)
    open_ = stage.where("parts is not null").select("doc_id", "k1", "k2", "text", "whole", "parts")
    starts = _repeated_starts(open_, length)
    # Starts within one document, so no more than its length.
    starts = starts.groupBy("k1", "k2").agg(F.collect_set("start").alias("starts"))

    def last(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                spans = [(w["start"], w["start"] + w["n"] + length - 1) for w in row["whole"] or ()]
                spans += [(s, s + length) for s in row["starts"] or ()]
                out.append(settled(row["doc_id"], row["text"].encode(), spans))
            arrays = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * len(kinds), kinds)]
            yield pa.record_batch(arrays, names=columns)

    finished = open_.join(starts, ["k1", "k2"], "left").select("doc_id", "text", "whole", "starts")
    return done.unionByName(finished.mapInArrow(last, output))


def op3_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document, and a digest of the rest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = _removed(docs, "doc_id", "text", LENGTH, TOGETHER, digest=True)
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.col("kept").alias("kept_sha256"),
    )
