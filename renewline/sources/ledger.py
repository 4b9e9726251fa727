"""Importing each file once, with ids that no other import uses.

A file is known by its content: the number, lengths and hashes of its lines, whatever their order or the file's
name. An import writes its lines and the fingerprints of its files into one folder beside the table, then
gives the folder its place in the table by one rename. So a file is in the ledger if and only if its lines are in
the table, and an import that failed anywhere before is simply run again.
"""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewline.sources import tables
from renewline.sources.contract_csv import accepted, read_by_header, rejected, resolve_references, typed_lines
from renewline.sources.files import FileSystem

#: Folder within an import that readers of the table skip.
_FILES = "_files"
#: Seconds to wait for another writer to finish its claim.
PATIENCE = 30


def claim_ids(spark: SparkSession, lines_path: str, count: int, name: str = "") -> int:
    """The first of ``count`` ids that no other claim overlaps; the same again for a ``name`` that has claimed as many.

    Claims are numbered files beside the table, each created by one writer only and beginning where the one
    before ends. The first begins after the largest id of the table.
    """
    folder = f"{lines_path.rstrip('/')}_claims"
    fs = FileSystem(spark, folder)
    fs.make(folder)
    mark = f"{folder}/of-{hashlib.sha256(name.encode()).hexdigest()}"
    if name and fs.exists(mark):
        first, many = map(int, _complete(fs, mark).split())
        if many == count:
            return first
    while True:
        claims = [n for n in fs.names(folder) if n.startswith("claim-")]
        if claims:
            first = sum(map(int, _complete(fs, f"{folder}/{claims[-1]}").split()))
            number = int(claims[-1].removeprefix("claim-")) + 1
        else:
            first, number = tables.next_line_id(spark, lines_path), 0
        if fs.create(f"{folder}/claim-{number:012d}", f"{first} {count}\n"):
            break
    if name:
        fs.delete(mark)
        fs.create(mark, f"{first} {count}\n")
    return first


def _complete(fs: FileSystem, path: str) -> str:
    """The text of a claim; its writer may be about to write it."""
    until = time.monotonic() + PATIENCE
    while not (text := fs.read(path)).endswith("\n"):
        if time.monotonic() > until:
            raise TimeoutError(f"{path} was never finished; delete it if its writer is gone")
        time.sleep(0.05)
    return text


def fingerprints(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Columns ``path``, ``rows`` and ``fingerprint`` of every file with any line."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    hashed = F.xxhash64("value")
    found = lines.groupBy("path").agg(
        F.count("*").alias("rows"),
        F.sum(F.octet_length("value")).alias("bytes"),
        F.sum(hashed.cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64("value", F.lit(1))).alias("mixed"),
    )
    return found.select("path", "rows", F.sha2(F.concat_ws("|", "rows", "bytes", "sum", "mixed"), 256).alias("fingerprint"))


def imported(spark: SparkSession, lines_path: str) -> DataFrame:
    """The ledger: ``path``, ``rows`` and ``fingerprint`` of every file whose lines are in the table."""
    fs = FileSystem(spark, lines_path)
    parts = [f"{lines_path}/{n}/{_FILES}" for n in fs.names(lines_path) if n.startswith("import-")]
    schema = "path string, rows long, fingerprint string"
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def new_files(spark: SparkSession, paths: str | list[str], lines_path: str) -> DataFrame:
    """The files whose content is not in the ledger, one of those with the same content."""
    found = fingerprints(spark, paths).groupBy("fingerprint").agg(F.min(F.struct("path", "rows")).alias("file"))
    known = imported(spark, lines_path).select("fingerprint").distinct()
    return found.join(known, "fingerprint", "left_anti").select("file.path", "file.rows", "fingerprint")


def import_files(
    spark: SparkSession,
    paths: str | list[str],
    lines_path: str,
    rejects_path: str,
    transactions: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    required: list[str] = (),
    multiline: bool | str = False,
) -> int:
    """Append the accepted lines of files not imported before and store the rejected rows; how many files those were.

    ``paths`` are files or a folder of one import; their names come to the driver. Rows of one import are resolved
    once, so a lookup table that changes meanwhile cannot put a row into both outputs. Imports of different files may run
    at the same time, as their ids are claimed; imports of the same file must not.
    """
    fresh = new_files(spark, paths, lines_path).collect()
    if not fresh:
        return 0
    name = "import-" + hashlib.sha256("".join(sorted(r["fingerprint"] for r in fresh)).encode()).hexdigest()[:32]
    fs = FileSystem(spark, lines_path)
    staged, outcome = f"{lines_path}/_{name}", f"{lines_path}/_outcome-{name}"
    raw = read_by_header(spark, [r["path"] for r in fresh], multiline)
    first = claim_ids(spark, lines_path, raw.count(), name)
    typed = typed_lines(raw, first, required)
    resolve_references(typed, transactions, customers, items).write.mode("overwrite").parquet(outcome)
    resolved = spark.read.parquet(outcome)
    rejected(resolved).write.mode("overwrite").parquet(f"{rejects_path}/{name}")
    accepted(resolved).write.mode("overwrite").parquet(staged)
    ledger = spark.createDataFrame(fresh, "path string, rows long, fingerprint string")
    ledger.coalesce(1).write.mode("overwrite").parquet(f"{staged}/{_FILES}")
    fs.rename(staged, f"{lines_path}/{name}")
    fs.delete(outcome)
    return len(fresh)
