"""CSV import of contract lines.

The file names transactions, customers and items as they are displayed. The
import finds columns by header, parses them and resolves the names to ids. A
row that cannot be read or resolved is kept apart with its text and the reasons,
so every row of the file is either accepted or rejected. Empty fields are legal:
no field is mandatory unless the caller says so.

Every row of a file gets a new id, without gaps; an id in the file names a record elsewhere and
stays in the text of a rejected row only. Quotes within quoted fields are doubled.
Line breaks within quoted fields are read with ``multiline="split"``, which finds the records
of a file in splits, or with ``multiline=True``, which reads a file in one task; without
either the pieces of such a row are rejected as unreadable.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renewline.functions.money import MONEY, TERM
from renewline.sources.quoted import whole_records
from renewline.sources.schemas import CONTRACT_LINES

# Fixed values of the import format. Its text is in windows-1252, which Spark does
# not read; it differs from ISO-8859-1 in the bytes 80 to 9F alone, so those
# characters are exchanged after reading.
ENCODING = "windows-1252"
READ_AS = "ISO-8859-1"
DELIMITER = ","
DATE_FORMAT = "M/d/yyyy"
ID_HEADER = "Internal ID"
HEADERS = [
    "Transaction",
    "Customer",
    "Item",
    "Contract",
    "Start Date",
    "End Date",
    "Term",
    "Total Amount",
]

#: Holds the text of a row that does not have the columns of the header.
UNREADABLE = "Unreadable"
RAW = [ID_HEADER, *HEADERS, UNREADABLE]


def csv_options() -> dict[str, str]:
    """Reader options; a later file with other headers fails instead of shifting columns."""
    return {
        "header": "true",
        "encoding": READ_AS,
        "sep": DELIMITER,
        "quote": '"',
        "escape": '"',
        "enforceSchema": "false",
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
    }


def _decoded(column: str) -> Column:
    differing = [bytes([b]) for b in range(0x80, 0xA0) if bytes([b]).decode(ENCODING, "ignore")]
    read = "".join(b.decode(READ_AS) for b in differing)
    meant = "".join(b.decode(ENCODING) for b in differing)
    return F.translate(F.col(column), read, meant)


def file_headers(spark: SparkSession, paths: str | list[str]) -> dict[str, tuple[str, ...]]:
    """The column names of every file, found in one job over their first splits."""
    text = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.decode(F.col("value").cast("binary"), READ_AS).alias("value"),
    )
    first = text.where("block = 0").groupBy("path").agg(F.min_by("value", "at").alias("value")).collect()
    return {r["path"]: tuple(c.strip() for c in next(csv.reader([r["value"].rstrip("\r")]), ())) for r in first}


def _mapped(raw: DataFrame, header: tuple[str, ...]) -> DataFrame:
    own_id = F.col(ID_HEADER) if ID_HEADER in header else F.lit(None).cast("string").alias(ID_HEADER)
    return raw.select(own_id, *HEADERS, UNREADABLE)


def _schema(header: tuple[str, ...]) -> T.StructType:
    missing = [h for h in HEADERS if h not in header]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return T.StructType([T.StructField(h, T.StringType()) for h in [*header, UNREADABLE]])


def _read_split(spark: SparkSession, path: str | list[str], header: tuple[str, ...]) -> DataFrame:
    """Records with line breaks in quoted fields, found in splits and then parsed one by one."""
    records = whole_records(spark, path).where("not first")
    text = F.regexp_replace(F.decode("record", READ_AS), r"\r$", "")
    records = records.select(text.alias("text")).where(F.trim("text") != "")
    options = {k: v for k, v in csv_options().items() if k not in ("header", "encoding", "enforceSchema")}
    options |= {"multiLine": "true", "columnNameOfCorruptRecord": UNREADABLE}
    # Line breaks in fields are read as one character; the text of an unreadable row stays as it is.
    fields = F.regexp_replace("text", "\r\n", "\n")
    parsed = F.from_csv(fields, F.lit(", ".join(f"`{f.name}` string" for f in _schema(header))), options)
    rows = records.select("text", parsed.alias("row")).select("text", "row.*")
    rows = rows.withColumn(UNREADABLE, F.when(F.col(UNREADABLE).isNotNull(), F.col("text")))
    return _mapped(rows, header)


def read_contract_csv(spark: SparkSession, path: str | list[str], multiline: bool | str = False) -> DataFrame:
    """The mapped columns of the files as text; others are dropped, a missing id is blank."""
    if multiline == "split":
        headers = set(file_headers(spark, path).values())
        if len(headers) > 1:
            raise ValueError("files with different headers: use read_by_header")
        return _read_split(spark, path, headers.pop() if headers else ())
    options = csv_options() | {"multiLine": str(multiline).lower()}
    header = spark.read.options(**options).csv(path).columns
    schema = _schema(tuple(header))
    raw = spark.read.schema(schema).options(**options, columnNameOfCorruptRecord=UNREADABLE).csv(path)
    return _mapped(raw, tuple(header))


def read_by_header(spark: SparkSession, paths: list[str], multiline: bool | str = False) -> DataFrame:
    """The rows of several files whose columns can stand in different orders."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in sorted(file_headers(spark, paths).items()):
        groups.setdefault(header, []).append(path)
    parts = [read_contract_csv(spark, files, multiline) for files in groups.values()]
    return reduce(DataFrame.unionByName, parts)


def numbered(rows: DataFrame, first_id: int, name: str) -> DataFrame:
    """Add ``name``: numbers upwards from ``first_id``, as many as there are rows, without gaps.

    Rows are counted per partition, and a running sum over the partitions gives each its first
    number. The rows are read twice and must fall into the same partitions both times, as those of files do.
    """
    part, place = "renewline part", "renewline place"
    placed = rows.withColumn(part, F.spark_partition_id()).withColumn(place, F.monotonically_increasing_id())
    counts = placed.groupBy(part).agg(F.count("*").alias("rows"))
    # One row for each partition.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    # The lower bits of the place count within the partition.
    within = F.col(place).bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    joined = placed.join(starts, part)
    return joined.select((F.lit(first_id).cast("long") + F.col("start") + within).alias(name), *rows.columns)


def _parsed(raw: DataFrame) -> dict[str, Column]:
    return {
        "Start Date": F.try_to_date(F.col("Start Date"), DATE_FORMAT),
        "End Date": F.try_to_date(F.col("End Date"), DATE_FORMAT),
        "Term": F.col("Term").try_cast(TERM),
        "Total Amount": F.col("Total Amount").try_cast(MONEY),
    }


def typed_lines(raw: DataFrame, first_id: int, required: list[str] = ()) -> DataFrame:
    """Parse the text columns; ``problems`` lists the fields that did not parse.

    Rows are numbered upwards from ``first_id``, without holes. ``required`` names the
    headers of mandatory fields. ``raw`` keeps the text of all columns.
    """
    unknown = [h for h in required if h not in HEADERS]
    if unknown:
        raise ValueError(f"no such columns: {', '.join(unknown)}")
    parsed = _parsed(raw)
    whole = F.col(UNREADABLE).isNull()
    wrong = [
        F.when(whole & F.col(h).isNotNull() & value.isNull(), f"unreadable {h}") for h, value in parsed.items()
    ]
    wrong += [F.when(whole & F.col(h).isNull(), f"missing {h}") for h in required]
    wrong.append(F.when(~whole, "unreadable row"))
    return numbered(raw, first_id, "line_id").select(
        "line_id",
        _decoded("Transaction").alias("transaction"),
        _decoded("Customer").alias("customer"),
        _decoded("Item").alias("item"),
        _decoded("Contract").alias("contractid"),
        parsed["Start Date"].alias("startdate"),
        parsed["End Date"].alias("enddate"),
        parsed["Term"].alias("term"),
        parsed["Total Amount"].alias("amount"),
        F.struct(*[_decoded(h).alias(h) for h in RAW]).alias("raw"),
        F.array_compact(F.array(*wrong)).alias("problems"),
    )


def _resolve(lines: DataFrame, name: str, key: str, names: DataFrame) -> DataFrame:
    """Replace a display name by its id; unknown and ambiguous names are problems."""
    known = names.groupBy("name").agg(F.min("id").alias(key), F.count("*").alias("owners"))
    joined = lines.join(known, lines[name] == known["name"], "left")
    problem = F.when(F.col(name).isNotNull() & F.col("owners").isNull(), f"unknown {name}").when(
        F.col("owners") > 1, f"ambiguous {name}"
    )
    return joined.select(
        *[c for c in lines.columns if c not in (name, "problems")],
        F.when(F.col("owners") == 1, F.col(key)).alias(key),
        F.array_compact(F.array_append("problems", problem)).alias("problems"),
    )


def resolve_references(
    lines: DataFrame, transactions: DataFrame, customers: DataFrame, items: DataFrame
) -> DataFrame:
    """Resolve the three display names through lookup tables of ``id, name``.

    ``raw`` goes through unchanged.
    """
    for name, key, names in (
        ("transaction", "tranid", transactions),
        ("customer", "customerid", customers),
        ("item", "itemid", items),
    ):
        lines = _resolve(lines, name, key, names)
    return lines.select(*CONTRACT_LINES.names, "raw", "problems")


def accepted(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.size("problems") == 0).select(*CONTRACT_LINES.names)


def rejected(resolved: DataFrame) -> DataFrame:
    """Rejected rows with the text they had, to be repaired, and all reasons."""
    return resolved.where(F.size("problems") > 0).select("line_id", "raw.*", "problems")


def import_contract_csv(
    spark: SparkSession,
    path: str | list[str],
    transactions: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    first_id: int,
    required: list[str] = (),
    multiline: bool | str = False,
) -> tuple[DataFrame, DataFrame]:
    """Accepted contract lines and rejected rows of a file or folder.

    ``first_id`` is the first id to give: ``tables.next_line_id`` for a table that the
    lines are appended to. Both results read the file and the lookup tables; store
    the first before the lookup tables change.
    """
    typed = typed_lines(read_contract_csv(spark, path, multiline), first_id, required)
    resolved = resolve_references(typed, transactions, customers, items)
    return accepted(resolved), rejected(resolved)
