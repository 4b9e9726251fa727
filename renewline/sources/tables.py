"""Reading and writing the tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renewline.operators.skew import split_by_keys
from renewline.operators.timeline import KEY
from renewline.sources.files import FileSystem
from renewline.sources.schemas import CONTRACT_LINES


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The columns of the schema; folders of import batches, and files beside them, are read as one table."""
    return _stored(spark, path, schema).select(*schema.names)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def next_line_id(spark: SparkSession, path: str) -> int:
    """The id after the largest of the table, 1 for a table that does not exist yet."""
    try:
        last = read_table(spark, path, CONTRACT_LINES).agg(F.max("line_id")).first()[0]
    except AnalysisException:
        return 1
    return 1 if last is None else last + 1


def append_lines(lines: DataFrame, path: str) -> None:
    """Add contract lines to the table; nothing already there is changed."""
    lines.select(*CONTRACT_LINES.names).write.mode("append").parquet(path)


def reset_lines(spark: SparkSession, path: str) -> None:
    """Delete all contract lines, keeping the table and its schema."""
    spark.createDataFrame([], CONTRACT_LINES).write.mode("overwrite").parquet(path)


def save_clustered(lines: DataFrame, table: str, buckets: int, hot: DataFrame | None = None) -> None:
    """Store contract lines bucketed by timeline.

    The timeline operators run on such a table without any exchange when called
    with ``clustered=True``. Writing exchanges the lines once by the same keys,
    so each task writes one bucket file instead of a piece of every bucket.

    A bucket holds its timelines whole. Those named by ``hot``, as found by
    ``hot_timelines``, go to the table ``<table>_hot`` instead, spread evenly and
    unbucketed; ``read_clustered`` gives both.
    """
    ordinary, big = (lines, None) if hot is None else split_by_keys(lines, KEY, hot)
    (
        ordinary.repartition(buckets, *KEY)
        .write.mode("overwrite")
        .bucketBy(buckets, *KEY)
        .sortBy(*KEY)
        .saveAsTable(table)
    )
    big = lines.where("false") if big is None else big
    big.write.mode("overwrite").saveAsTable(f"{table}_hot")


def read_clustered(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame]:
    """The bucketed lines, and those of the hot timelines."""
    return spark.table(table), spark.table(f"{table}_hot")


def replace_table(df: DataFrame, path: str, format: str = "parquet", **options: str) -> None:
    """Write beside ``path``, then switch: until all rows are written the old table stays as it is.

    A job that fails leaves the old table readable. The switch is two renames; if the driver is lost between
    them, ``recover_table`` gives the old table its name back.
    """
    fs = FileSystem(df.sparkSession, path)
    path = path.rstrip("/")
    recover_table(df.sparkSession, path)
    folder, name = path.rsplit("/", 1)
    staged, old = (f"{folder}/_{kind}-{name}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    try:
        df.write.options(**options).format(format).save(staged)
        if fs.exists(path):
            fs.rename(path, old)
        fs.rename(staged, path)
    finally:
        fs.delete(staged)
    fs.delete(old)


def recover_table(spark: SparkSession, path: str) -> bool:
    """After a switch that was cut off: the old table under its name again. Nothing to do otherwise."""
    fs = FileSystem(spark, path)
    folder, name = path.rstrip("/").rsplit("/", 1)
    kept = [n for n in fs.names(folder) if n.startswith(f"_old-{name}-")]
    if kept and not fs.exists(path):
        fs.rename(f"{folder}/{kept[-1]}", path)
        return True
    return False


def save_report(report: DataFrame, path: str, format: str = "parquet") -> None:
    """Store a report; one stored before stays readable until the new one is complete."""
    replace_table(report, path, format, **({"header": "true"} if format == "csv" else {}))


_REFERENCES = ("tranid", "customerid", "itemid")


def null_deleted(spark: SparkSession, path: str, deleted: dict[str, DataFrame]) -> list[str]:
    """Set references to deleted records to NULL, in the files that hold any; the names of those files.

    ``deleted`` gives the deleted ids, column ``id``, for any of tranid, customerid and itemid. Only these ids are
    joined, not the parents that are left; files without a reference to them are neither written nor renamed. A
    file is replaced by its new rows under another name: the new file comes first, so a failure leaves
    rows twice at worst, and ``repair_deleted`` takes the older copy away.
    """
    unknown = set(deleted) - set(_REFERENCES)
    if unknown:
        raise ValueError(f"no such references: {', '.join(sorted(unknown))}")
    repair_deleted(spark, path)
    lines = _stored(spark, path, CONTRACT_LINES)
    lines = lines.select(*CONTRACT_LINES.names, F.col("_metadata.file_path").alias("file"))
    hits = [
        lines.join(ids.select(F.col("id").alias(key)).distinct(), key, "left_semi").select("file")
        for key, ids in deleted.items()
    ]
    files = sorted({r["file"] for part in hits for r in part.distinct().collect()})
    if not files:
        return []
    fs = FileSystem(spark, path)
    rows = lines.where(F.col("file").isin(files))
    for key, ids in deleted.items():
        gone = ids.select(F.col("id").alias("gone")).distinct()
        rows = rows.join(gone, rows[key] == gone["gone"], "left")
        rows = rows.withColumn(key, F.when(F.col("gone").isNull(), F.col(key))).drop("gone")
    staged = f"{path.rstrip('/')}/_without-{uuid.uuid4().hex}"
    # The rows of a file stay together, so each is rewritten by one task.
    rows = rows.select(*CONTRACT_LINES.names, F.sha1("file").alias("of"))
    rows.repartition("of").write.partitionBy("of").parquet(staged)
    for file in files:
        folder, _ = file.rsplit("/", 1)
        of = _digest(file)
        for part in fs.names(f"{staged}/of={of}"):
            fs.rename(f"{staged}/of={of}/{part}", f"{folder}/instead-{of}-{uuid.uuid4().hex[:8]}.parquet")
        fs.delete(file)
    fs.delete(staged)
    return files


def _digest(file: str) -> str:
    return hashlib.sha1(file.encode()).hexdigest()


def repair_deleted(spark: SparkSession, path: str) -> None:
    """Delete files that a run of ``null_deleted`` has replaced but could not delete any more."""
    found = _stored(spark, path, CONTRACT_LINES).select(F.col("_metadata.file_path").alias("file"))
    files = [r["file"] for r in found.distinct().collect()]
    replaced = {f.rsplit("/", 1)[1].split("-")[1] for f in files if f.rsplit("/", 1)[1].startswith("instead-")}
    fs = FileSystem(spark, path)
    for file in files:
        if _digest(file) in replaced:
            fs.delete(file)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Name the tables for ``spark.sql``."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def row_maps(result: DataFrame) -> Iterator[dict]:
    """Rows as dicts, fetched one partition at a time; meant for small results."""
    for row in result.toLocalIterator():
        yield row.asDict()
