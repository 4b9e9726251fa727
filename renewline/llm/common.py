"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch. Texts can be long, so batches are kept small.
BATCH_ROWS = 512
BATCH_BYTES = 32 << 20


def scratch_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share for intermediate data.

    It is the one named by ``spark.checkpoint.dir``. Where that is unset, a local
    session gets a temporary folder; any other session must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="renewline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and return them as read from there.

    Cuts the lineage, so that a lost executor costs no recomputation beyond this
    point. The files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/renewline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def small_batches(spark: SparkSession) -> None:
    """Limit the rows and bytes of an Arrow batch, so that Python workers hold few texts at once."""
    prefix = "spark.sql.execution.arrow."
    if int(spark.conf.get(f"{prefix}maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set(f"{prefix}maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set(f"{prefix}maxBytesPerBatch", str(BATCH_BYTES))


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that the frame does not have yet, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"{wish}_"
    return wish


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that helper columns beside it cannot clash."""
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in df.columns))


def map_batches(docs: DataFrame, change) -> DataFrame:
    """Arrow batches of all columns through ``change``, which keeps the columns; names of any kind are taken."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            out = change(pa.RecordBatch.from_arrays(batch.columns, names=names))
            yield pa.RecordBatch.from_arrays(out.columns, names=names)

    return docs.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(run, docs.schema)


#: Bits of a key filter, as a power of two: 4 MB. With more keys it lets more through.
FILTER_BITS = 25


def _places(key: Column, bits: int) -> list[Column]:
    mask = F.lit((1 << bits) - 1).cast("long")
    return [key.bitwiseAND(mask), F.shiftrightunsigned(key, 32).bitwiseAND(mask)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit array of 2^bits with two places set for every value of the long column ``key``.

    What comes to the driver is bounded by the bits, whatever the number of keys.
    """
    place = keys.select(F.explode(F.array(*_places(F.col("key"), bits))).alias("place"))
    words = place.select(F.shiftright("place", 6).alias("slot"), _bit(F.col("place")).alias("bit"))
    found = words.groupBy("slot").agg(F.bit_or("bit").alias("word")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["slot"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return out


def passes(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be among those the filter was made of; all that are do pass."""
    mask = np.uint64(len(filter_) * 64 - 1)
    out = np.ones(len(keys), bool)
    for place in (keys & mask, (keys >> np.uint64(32)) & mask):
        out &= (filter_[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


def passing(spark: SparkSession, filter_: np.ndarray, key: Column) -> Column:
    """The same test as an SQL condition; the bits go to tasks as one value."""
    bits = len(filter_).bit_length() + 5
    words = pa.array([filter_.view(np.int64)], pa.list_(pa.int64()))
    held = spark.createDataFrame(pa.table({"words": words})).scalar()
    found = F.lit(True)
    for place in _places(key, bits):
        found = found & (F.get(held, F.shiftright(place, 6).cast("int")).bitwiseAND(_bit(place)) != 0)
    return found


def row_salt(df_rows: int, rows_per_task: int) -> int:
    """How many parts a group is split into so that a part stays near rows_per_task rows."""
    return max(1, -(-df_rows // rows_per_task))


def part_of(columns: list[str], parts: int | Column) -> Column:
    """A part for each row, from a checksum of its columns."""
    return F.crc32(F.concat_ws("|", *(F.col(c).cast("string") for c in columns))) % parts


def positions(
    df: DataFrame, group: list[str], order: list[Column], salt: Column, name: str = "position"
) -> DataFrame:
    """Number the rows of each group from 0 without gaps.

    A group can hold any share of all rows: it is cut into parts by ``salt``, the
    parts are counted map-side, and only a part has to fit into one task. Rows go
    by part, then by ``order``.
    """
    parts = df.withColumn("_part", salt)
    keys = [*group, "_part"]
    counts = parts.groupBy(*keys).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    numbered = parts.withColumn(
        "_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    )
    joined = numbered.join(starts, keys)
    return joined.withColumn(name, F.col("_start") + F.col("_row")).drop("_part", "_start", "_row")
