"""SimHash fingerprints, and their links by vantage-point trees.

A fingerprint is the bitwise majority over the hashes of a text's shingles. Links
join fingerprints that differ in few bits; they are found exactly:

1. Fingerprints are cut into one block of bits more than may differ, so linked ones
   agree in a whole block. Agreement in a block is block distance 0 to one of its
   values, and with radius 0 no shard overlaps another. Each block deals out shards.
2. A shard above ``shard_rows`` is split by a vantage point, its smallest
   fingerprint: near ones inside the median distance, far ones outside. By the
   triangle bound, an outside point linked to an inside point lies at most the
   radius beyond the boundary. Those points go to the inside shard as well.
   This repeats while shards are too large and still shrink.
3. A shard is one vantage-point tree in memory. All its points query it together;
   a branch that the triangle bound excludes is never entered.

A shard returns links that span each of its connected sets, not all pairs, so a group
of n near copies gives in the order of n links. Components of the links follow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from renewline.llm.common import key_filter, materialize, passing, small_batches, whole_row
from renewline.llm.components import connected_components

BITS = 64
SEED = 42
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
#: Points one task takes as a shard; larger shards are split by vantage points.
SHARD_ROWS = 50_000
#: Points in a leaf of the tree in memory.
LEAF_ROWS = 64
#: Hashes whose bits are counted at once.
HASH_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is 1 if it is set in over half the shingle hashes; 0 for a text without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    starts, ends = starts[:n].tolist(), ends[len(ends) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, HASH_CHUNK):
        hashes = [digest(flat[s:e], SEED) for s, e in zip(starts[at : at + HASH_CHUNK], ends[at : at + HASH_CHUNK])]
        rows = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash`` and ``fp``, the 64 bits as a signed long."""
    small_batches(docs.sparkSession)

    def compute(batches):
        for batch in batches:
            fps = [fingerprint(t, shingle_words) for t in batch.column(2).to_pylist()]
            values = np.array(fps, np.uint64).view(np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(values)]
            yield pa.record_batch(columns, names=["doc_id", "text_hash", "fp"])

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )
    return rows.mapInArrow(compute, "doc_id long, text_hash long, fp long")


def blocks(max_distance: int) -> list[tuple[int, int]]:
    """(offset, width) of one block of bits more than may differ, of nearly equal widths."""
    count = max_distance + 1
    cuts = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _sharded(points: DataFrame, max_distance: int) -> DataFrame:
    """Every point once per block, with its shard: the block and the value of its bits."""
    keys = [
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1)).alias("value"),
        )
        for i, (at, width) in enumerate(blocks(max_distance))
    ]
    return points.select("fp", F.explode(F.array(*keys)).alias("s")).select(
        "fp", "s.block", "s.value", F.lit("").alias("path")
    )


SHARD = ["block", "value", "path"]


def _split(points: DataFrame, max_distance: int, shard_rows: int) -> DataFrame:
    """Split shards by vantage points until each fits, or stops shrinking."""
    done = None
    open_ = points
    while True:
        sizes = materialize(
            open_.groupBy(*SHARD).agg(F.count("*").alias("n"), F.min("fp").alias("vantage")).where(F.col("n") > shard_rows)
        )
        if sizes.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        # Large shards are few: their number is at most the points over shard_rows.
        marked = open_.join(sizes, SHARD, "left")
        near = marked.where("n is not null").withColumn(
            "d", F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage")))
        )
        rings = near.groupBy(*SHARD, "d").agg(F.count("*").alias("m"), F.first("n").alias("n"))
        upto = Window.partitionBy(*SHARD).orderBy("d")
        halo = upto.rangeBetween(1, max_distance)
        rings = rings.withColumn("inside", F.sum("m").over(upto)).withColumn(
            "both", F.coalesce(F.sum("m").over(halo), F.lit(0))
        )
        # The cut whose larger side is smallest; sides must lose a tenth of the rows.
        side = F.greatest(F.col("inside") + F.col("both"), F.col("n") - F.col("inside"))
        cuts = rings.groupBy(*SHARD).agg(
            F.min(F.struct(side.alias("side"), F.col("d").alias("radius"), F.col("n").alias("n"))).alias("cut")
        ).select(*SHARD, "cut.radius", (F.col("cut.side") <= 0.9 * F.col("cut.n")).alias("shrinks"))
        cuts = materialize(cuts)
        cut = materialize(marked.join(cuts, SHARD, "left"))
        d = F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage")))
        whole = cut.where("n is null or not shrinks").select("fp", *SHARD)
        sides = F.filter(
            F.array(
                F.when(d <= F.col("radius") + max_distance, F.concat("path", F.lit("0"))),
                F.when(d > F.col("radius"), F.concat("path", F.lit("1"))),
            ),
            lambda p: p.isNotNull(),
        )
        parts = cut.where("shrinks").select("fp", "block", "value", F.explode(sides).alias("path"))
        done = whole if done is None else done.unionByName(whole)
        open_ = materialize(parts)


def tree_links(points: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (index pairs) that span all sets connected within max_distance.

    ``points`` are distinct uint64 values. The tree is walked with all queries at
    once: a node takes those for which neither triangle bound excludes it.
    """
    firsts: list[np.ndarray] = []
    seconds: list[np.ndarray] = []

    def visit(members: np.ndarray, queries: np.ndarray) -> None:
        if not len(members) or not len(queries):
            return
        if len(members) > LEAF_ROWS:
            vantage = points[members[0]]
            d = np.bitwise_count(points[members] ^ vantage).astype(np.int16)
            radius = int(np.median(d))
            if radius == d.max():
                radius -= 1
            if (d <= radius).any():
                dq = np.bitwise_count(points[queries] ^ vantage).astype(np.int16)
                visit(members[d <= radius], queries[dq <= radius + max_distance])
                visit(members[d > radius], queries[dq > radius - max_distance])
                return
        for at in range(0, len(queries), 4096):
            for of in range(0, len(members), 4096):
                _leaf(points, members[of : of + 4096], queries[at : at + 4096], max_distance, firsts, seconds)

    everything = np.arange(len(points))
    visit(everything, everything)
    if not firsts:
        none = np.zeros(0, np.int64)
        return none, none
    return np.concatenate(firsts), np.concatenate(seconds)


def _leaf(points, members, queries, max_distance, firsts, seconds) -> None:
    """Spanning links between queries and members: each one to the smallest it reaches here."""
    near = np.bitwise_count(points[queries][:, None] ^ points[members][None, :]) <= max_distance
    near &= queries[:, None] != members[None, :]
    rows, columns = near.any(axis=1), near.any(axis=0)
    if not rows.any():
        return
    near, queries, members = near[np.ix_(rows, columns)], queries[rows], members[columns]
    far = len(points)
    label = members.copy()
    while True:
        row = np.where(near, label[None, :], far).min(axis=1)
        row = np.minimum(row, queries)
        new = np.minimum(label, np.where(near, row[:, None], far).min(axis=0))
        if (new == label).all():
            break
        label = new
    for own, root in ((queries, row), (members, label)):
        other = own != root
        firsts.append(own[other])
        seconds.append(root[other])


def _spanning(points: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """One link per point that is not the first of its connected set."""
    a, b = tree_links(points, max_distance)
    parent = list(range(len(points)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.array([root(x) for x in range(len(points))], np.int64)
    child = np.flatnonzero(roots != np.arange(len(points)))
    return points[child], points[roots[child]]


def links(points: DataFrame, max_distance: int = MAX_DISTANCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that span all connected sets."""
    sharded = _split(_sharded(points, max_distance), max_distance, shard_rows)
    dealt = sharded.repartition(*SHARD).sortWithinPartitions(*SHARD, "fp")
    dealt = dealt.select(F.xxhash64(*SHARD).alias("shard"), "fp")

    def search(batches):
        shard, held = None, []

        def found(fps: list[np.ndarray]):
            points = np.unique(np.concatenate(fps)).view(np.uint64)
            if len(points) < 2:
                return None
            a, b = _spanning(points, max_distance)
            return (a.view(np.int64), b.view(np.int64)) if len(a) else None

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            cuts = np.flatnonzero(np.diff(keys)) + 1
            bounds = [0, *cuts.tolist(), len(keys)]
            out = []
            for lo, hi in zip(bounds, bounds[1:]):
                if held and keys[lo] != shard:
                    out.append(found(held))
                    held = []
                shard = keys[lo]
                held.append(fps[lo:hi])
            out = [x for x in out if x]
            if out:
                yield _pairs(out)
        if held and (last := found(held)):
            yield _pairs([last])

    return dealt.mapInArrow(search, "a long, b long").distinct()


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate(x) for x in zip(*found))
    return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``fp``, ``root`` and ``component_id``.

    ``root`` is the smallest fingerprint of the group and ``component_id`` the smallest doc_id among the documents reached by links;
    it is null only where none of them has an id. Null, empty and blank texts have
    fingerprint 0 and are linked like any other. Repeated rows stay repeated.
    """
    fps = materialize(fingerprints(docs, doc_id, text, shingle_words))
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    found = connected_components(links(distinct.select("fp"), max_distance, shard_rows))
    rooted = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialize(rooted)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = materialize(rooted.join(smallest, "root").select("fp", "root", "component_id"))
    return fps.join(classes, "fp", "left").select("doc_id", "text_hash", "fp", "root", "component_id")


def fates(found: DataFrame) -> DataFrame:
    """Keys (``id``, ``missing``, ``hash``) of the rows that do not simply stay, with ``goes``.

    Of a group the row with its smallest id stays, or that with the smallest text hash where several
    rows have that id or none has one. Keys that stay are listed only where they repeat. Keys are
    narrow, and a group is never brought together: all but the rows of its smallest id go at once.
    """
    keys = found.groupBy("root", "component_id", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = keys.where(own)
    least = first.groupBy(F.col("root").alias("of")).agg(F.min("text_hash").alias("least"))
    first = first.join(least, F.col("root") == F.col("of")).withColumn("goes", F.col("text_hash") != F.col("least"))
    every = first.where("goes or rows > 1").unionByName(keys.where(~own).withColumn("goes", F.lit(True)), True)
    return every.select(*_key(F.col("doc_id"), F.col("text_hash")), "goes")


def _key(doc_id: Column, text_hash: Column) -> list[Column]:
    zero = F.lit(0).cast("long")
    return [
        F.coalesce(doc_id.cast("long"), zero).alias("id"),
        doc_id.cast("long").isNull().alias("missing"),
        text_hash.alias("hash"),
    ]


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each group of near duplicates, all columns unchanged, whatever their names.

    It is the row with the smallest id, or with the smallest text hash where no row of
    the group has an id; of rows that repeat both id and text, any one.

    Groups are decided on ids and hashes. A filter of fixed size then tells which rows may
    have to go; the others, nearly all that stay, are not moved. Rows that may have to go look
    their fate up, and those that repeat a key that stays are reduced map-side to one.
    """
    spark = docs.sparkSession
    decided = materialize(fates(near_duplicates(docs, doc_id, text, **options)))
    key = ["id", "missing", "hash"]
    name = F.xxhash64(*_key(F.col(doc_id), F.xxhash64(text)))
    bits = key_filter(decided.select(F.xxhash64(*key).alias("key")))
    may_go = passing(spark, bits, name)
    doubtful = docs.where(may_go).select(whole_row(docs).alias("row"), *_key(F.col(doc_id), F.xxhash64(text)))
    doubtful = doubtful.join(decided, key, "left").where("goes is null or not goes")
    alone = doubtful.where("goes is null").select("row.*")
    once = doubtful.where("not goes").groupBy(*key).agg(F.first("row").alias("row")).select("row.*")
    return docs.where(~may_go).unionByName(alone).unionByName(once)


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )
