"""Sharding along a Hilbert curve, so that a filter on any dimension reads few shards.

Metadata dimensions are quantised to a few bits each, the Hilbert index of the cell
orders the rows, and the order is cut into runs of equal row counts. Rows of nearby
cells lie in one run, so minimum and maximum statistics of every dimension stay narrow.

Positions come from counts, never from one sorted partition: rows of a cell are split
into parts by a hash of the row, parts are counted map-side, and the cumulative counts
of coarse cells, cells and parts give each part its first position. A task only numbers
the rows of a part, however many rows share a cell.

A null counts as level 0 of its dimension. Ties within a cell go by part, id, size and
checksum; repeated rows take one position each. An empty table gives an empty result.
Everything is built from SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from renewline.llm.common import materialize, part_of, whole_row

SHARDS = 8
#: Bits of each dimension.
LEVEL_BITS = 4
#: Rows of a cell that one task numbers.
ROWS_PER_TASK = 1_000


def hilbert_index(levels: list[Column], bits: int = LEVEL_BITS) -> Column:
    """Index along the Hilbert curve of a cell, given its level in each dimension.

    Levels are walked from the highest bit down: a set bit flips the lower bits of the
    first dimension, a clear one swaps those that differ; then the Gray code of the
    transposed bits is undone and the bits are interleaved. The state travels as an
    array, so every step is computed once.
    """
    dims = len(levels)
    state = F.array(*(level.cast("int") for level in levels))
    for b in range(bits - 1, 0, -1):
        for i in range(dims):
            state = _apply(state, _unwind(dims, i, b))
    state = _apply(state, lambda x: _ungray(x, dims, bits))
    return _apply(state, lambda x: _interleave(x, dims, bits))


def _apply(state: Column, step) -> Column:
    """step(state) with the state computed once."""
    return F.element_at(F.transform(F.array(state), step), 1)


def _unwind(dims: int, i: int, b: int):
    """The step for bit b of dimension i."""
    low = (1 << b) - 1

    def step(x: Column) -> Column:
        isset = F.shiftright(x[i], b).bitwiseAND(1) == 1
        differ = x[0].bitwiseXOR(x[i]).bitwiseAND(low)
        first = F.when(isset, x[0].bitwiseXOR(F.lit(low))).otherwise(x[0].bitwiseXOR(differ))
        other = F.when(isset, x[i]).otherwise(x[i].bitwiseXOR(differ))
        return F.array(*(first if k == 0 else other if k == i else x[k] for k in range(dims)))

    return step


def _ungray(x: Column, dims: int, bits: int) -> Column:
    values = [x[0]]
    for k in range(1, dims):
        values.append(x[k].bitwiseXOR(values[-1]))
    # Every set bit but the lowest of the last dimension flips the bits below it.
    flip = F.lit(0)
    for b in range(bits - 1, 0, -1):
        mask = (1 << b) - 1
        flip = flip.bitwiseXOR(
            F.when(F.shiftright(values[-1], b).bitwiseAND(1) == 1, F.lit(mask)).otherwise(F.lit(0))
        )
    return F.array(*(v.bitwiseXOR(flip) for v in values))


def _interleave(x: Column, dims: int, bits: int) -> Column:
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            bit = F.shiftright(x[i], b).bitwiseAND(1).cast("long")
            index = F.shiftleft(index, 1).bitwiseOR(bit)
    return index


def shard_by_curve(
    rows: DataFrame,
    index: str,
    order: list[str],
    shards: int = SHARDS,
    rows_per_task: int = ROWS_PER_TASK,
    coarse_bits: int = LEVEL_BITS * 2,
    index_bits: int = LEVEL_BITS * 4,
) -> DataFrame:
    """Add ``shard`` and ``slot``: runs along ``index`` whose counts differ by one at most.

    The slot numbers the rows of a shard from 0 in curve order.
    """
    total = rows.count()
    at = F.col("index")
    held = rows.select(whole_row(rows).alias("row"), F.col(index).alias("index"))
    # Each cell is cut by its own count, so there are about as many parts as cells and full tasks together.
    cells = held.groupBy("index").agg(F.count("*").alias("cell"))
    cuts = F.ceil(F.col("cell") / rows_per_task).cast("int")
    inner = [f"row.{c}" for c in order]
    parts = held.join(cells, "index").select(
        "row", "index", F.shiftright(at, index_bits - coarse_bits).alias("coarse"), part_of(inner, cuts).alias("part")
    )
    part = ["coarse", "index", "part"]
    counts = parts.groupBy(*part).agg(F.count("*").alias("rows"))
    # Coarse cells are at most 2 ** coarse_bits rows; the rest is numbered within each.
    coarse = counts.groupBy("coarse").agg(F.sum("rows").alias("all"))
    before = Window.orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.select("coarse", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("coarse").orderBy("index", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("rows").over(within), F.lit(0)))
    starts = starts.join(coarse, "coarse").select(*part, (F.col("base") + F.col("start")).alias("start"))
    numbered = parts.withColumn("number", F.row_number().over(Window.partitionBy(*part).orderBy(*inner)) - 1)
    placed = numbered.join(starts, part).withColumn("at", F.col("start") + F.col("number"))
    # Shard k begins at the smallest position p with p * shards >= k * total.
    placed = placed.withColumn("run", F.expr(f"(at * {shards}) div {max(total, 1)}"))
    first = F.expr(f"(run * {total} + {shards - 1}) div {shards}")
    return placed.select("row.*", (F.col("at") - first).alias("slot"), F.col("run").cast("int").alias("shard"))


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def levels(docs: DataFrame) -> list[Column]:
    """Levels of a document: language, source, doubling of its size, range of its id."""
    top = 1 << LEVEL_BITS
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    span = F.lit((high or 0) - (low or 0) + 1).cast("decimal(20,0)")
    ids = F.floor((F.col("doc_id").cast("decimal(20,0)") - F.lit(low or 0)) * top / span)
    doubling = F.length(F.bin(F.col("size"))) - 1

    def named(name: str) -> Column:
        return F.pmod(F.crc32(F.col(name).cast("string")), F.lit(top))

    raw = [named("lang"), named("source"), F.least(doubling, F.lit(top - 1)), ids]
    return [F.coalesce(level.cast("int"), F.lit(0)) for level in raw]


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; counts differ by one at most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = docs.select(
        "doc_id",
        "lang",
        "source",
        text_size(F.col("text")).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
    )
    # Texts are read once; numbering works on the narrow rows.
    cells = materialize(
        sized.select("doc_id", "size", "text_crc32", hilbert_index(levels(sized)).alias("hilbert"))
    )
    sharded = shard_by_curve(cells, "hilbert", ["doc_id", "size", "text_crc32"])
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


def write_shards(rows: DataFrame, path: str) -> None:
    """Write rows that have ``shard`` and ``slot`` into one folder per shard, in slot order."""
    ordered = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
