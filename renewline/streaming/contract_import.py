"""Appending newly arrived CSV files to the contract lines, each file once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from renewline.sources import tables
from renewline.sources.contract_csv import (
    accepted,
    read_by_header,
    rejected,
    resolve_references,
    typed_lines,
)

#: Files of one batch; their names come to the driver.
FILES_PER_BATCH = 1_000


def _progress_folder(spark: SparkSession, name: str) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{root.rstrip('/')}/{name}"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows an earlier run of the batch has written completely, or None."""
    try:
        return spark.read.parquet(path) if spark.read.text(f"{path}/_SUCCESS").count() >= 0 else None
    except AnalysisException:
        return None


def import_new_files(
    spark: SparkSession,
    folder: str,
    lines_path: str,
    rejects_path: str,
    transactions: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    name: str = "contract_import",
    required: list[str] = (),
) -> StreamingQuery:
    """Import the files not seen yet and stop; run it again for later files.

    The stream carries the names of new files; each file's columns are found by its
    own header. A batch is resolved once, and the outcome is stored before anything
    else is written. So a lookup table that changes meanwhile, or a batch that is run
    again after a failure, cannot put a row into both outputs or into neither: both
    are copies of the stored outcome, in a folder of the batch that is overwritten.

    Progress is kept under ``name`` in ``spark.checkpoint.dir``, so every folder
    needs its own name. Nothing else may append to ``lines_path`` during a run.
    """
    progress = _progress_folder(spark, name)

    def take(batch: DataFrame, number: int) -> None:
        outcome = f"{progress}/outcome/{number}"
        resolved = _stored(spark, outcome)
        if resolved is None:
            files = [row["path"] for row in batch.select("path").collect()]
            if not files:
                return
            typed = typed_lines(
                read_by_header(spark, files), tables.next_line_id(spark, lines_path), required
            )
            decided = resolve_references(typed, transactions, customers, items)
            decided.write.mode("overwrite").parquet(outcome)
            resolved = spark.read.parquet(outcome)
        accepted(resolved).write.mode("overwrite").parquet(f"{lines_path}/batch={number}")
        rejected(resolved).write.mode("overwrite").parquet(f"{rejects_path}/batch={number}")

    # Only the path is used, so no content is read here.
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .load(folder)
        .select("path")
    )
    return (
        names.writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{progress}/stream")
        .trigger(availableNow=True)
        .start()
    )
