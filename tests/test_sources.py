from __future__ import annotations

import uuid
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

from renewline.operators import checks
from renewline.operators.periods import monthly_periods, overlapping_periods
from renewline.plans import reports as r
from renewline.sources import contract_csv, schemas, tables
from renewline.streaming.contract_import import import_new_files
from tests.fixtures import (
    CUSTOMERS,
    ITEMS,
    TRANSACTIONS,
    dimensions,
    line,
    lines_frame,
    month_rows,
    periods_frame,
)

HEADER = "Internal ID,Transaction,Customer,Item,Contract,Start Date,End Date,Term,Total Amount"
#: A whole and a fractional term, a blank contract and a name with a comma and quotes.
ROWS = [
    "40,Bill 6,3 Karl Adeyemi,Roof tiles,K-7,11/5/2019,2/19/2020,3.5,812.40",
    '41,Bill 2,"6 ""Bo"" Lindt, Sons",Garden tools,,2/1/2020,9/30/2020,8,77.04',
]


@pytest.fixture(scope="module")
def names(spark):
    """Lookup tables of id and display name: transactions, customers, items."""
    customers = [(i, f"{i} {first or ''} {last}") for i, first, last, *_ in CUSTOMERS]
    customers.append((6, '6 "Bo" Lindt, Sons'))
    tables = ([x[:2] for x in TRANSACTIONS], customers, [x[:2] for x in ITEMS])
    return [spark.createDataFrame(rows, "id long, name string") for rows in tables]


def write(path, *rows, header=HEADER, encoding="windows-1252"):
    path.write_bytes("\r\n".join([header, *rows]).encode(encoding))
    return str(path)


def test_import(spark, tmp_path, names):
    good, bad = contract_csv.import_contract_csv(spark, write(tmp_path / "a.csv", *ROWS), *names, first_id=1)
    assert good.columns == schemas.CONTRACT_LINES.names
    assert [f.dataType for f in good.schema] == [f.dataType for f in schemas.CONTRACT_LINES]
    assert sorted(tuple(x)[1:] for x in good.collect()) == [
        (2, 6, 1, None, date(2020, 2, 1), date(2020, 9, 30), Decimal(8), Decimal("77.04")),
        (6, 3, 2, "K-7", date(2019, 11, 5), date(2020, 2, 19), Decimal("3.5"), Decimal("812.40")),
    ]
    assert bad.count() == 0


def test_columns_are_found_by_header(spark, tmp_path, names):
    header = "Term,Extra,Total Amount,Transaction,Customer,Item,Contract,End Date,Start Date"
    path = write(
        tmp_path / "b.csv", "2,x,90.10,Bill 3,2 Ines Moreau,Roof tiles,9,8/31/2020,7/1/2020", header=header
    )
    good, _ = contract_csv.import_contract_csv(spark, path, *names, first_id=1)
    row = good.first()
    assert (row["startdate"], row["enddate"], row["term"]) == (date(2020, 7, 1), date(2020, 8, 31), 2)
    with pytest.raises(ValueError, match="Total Amount"):
        contract_csv.read_contract_csv(spark, write(tmp_path / "c.csv", header="Transaction,Term"))


def test_encoding(spark, tmp_path, names):
    transactions, _, items = names
    customers = spark.createDataFrame([(7, "7 Zoë “Z” Müller €")], "id long, name string")
    row = "1,Bill 3,7 Zoë “Z” Müller €,Roof tiles,1,5/1/2020,5/31/2020,1,8.00"
    good, _ = contract_csv.import_contract_csv(
        spark, write(tmp_path / "d.csv", row), transactions, customers, items, first_id=1
    )
    assert good.first()["customerid"] == 7


def test_every_row_is_accepted_or_rejected_with_its_text(spark, tmp_path, names):
    transactions, customers, items = names
    twice = items.union(spark.createDataFrame([(8, "Roof tiles")], items.schema))
    rows = [
        "1,Bill 3,2 Ines Moreau,Garden tools,1,5/1/2020,5/31/2020,1,8.00",
        "2,,,,,,,,",
        "3,Bill 77,2 Ines Moreau,Garden tools,1,5/1/2020,5/31/2020,1,8.00",
        "4,Bill 3,2 Ines Moreau,Roof tiles,1,5/1/2020,5/31/2020,1,8.00",
        "5,Bill 3,2 Ines Moreau,Garden tools,1,13/1/2020,31.3.2020,three,8.00",
    ]
    path = write(tmp_path / "e.csv", *rows)
    good, bad = contract_csv.import_contract_csv(spark, path, transactions, customers, twice, first_id=1)
    assert good.count() == 2
    found = {x["Internal ID"]: x for x in bad.collect()}
    assert {k: x["problems"] for k, x in found.items()} == {
        "3": ["unknown transaction"],
        "4": ["ambiguous item"],
        "5": ["unreadable Start Date", "unreadable End Date", "unreadable Term"],
    }
    assert (found["3"]["Transaction"], found["3"]["Customer"]) == ("Bill 77", "2 Ines Moreau")
    assert (found["5"]["Start Date"], found["5"]["Term"]) == ("13/1/2020", "three")


def test_line_breaks_in_quotes(spark, tmp_path, names):
    transactions, _, items = names
    customers = spark.createDataFrame([(7, "7 Two\nlines"), (2, "2 Ines Moreau")], "id long, name string")
    path = tmp_path / "f.csv"
    path.write_bytes(
        (HEADER + "\n" + '1,Bill 3,"7 Two\nlines",Roof tiles,1,5/1/2020,5/31/2020,1,8.00\n'
         + "2,Bill 4,2 Ines Moreau,Roof tiles,1,5/1/2020,5/31/2020,1,9.00\n").encode()
    )
    lookups = (transactions, customers, items)
    good, bad = contract_csv.import_contract_csv(spark, str(path), *lookups, first_id=1, multiline=True)
    assert sorted(x["customerid"] for x in good.collect()) == [2, 7]
    assert bad.count() == 0
    good, bad = contract_csv.import_contract_csv(spark, str(path), *lookups, first_id=1)
    assert [x["customerid"] for x in good.collect()] == [2]
    rows = bad.collect()
    assert len(rows) == 2 and all("unreadable row" in x["problems"] and x["Unreadable"] for x in rows)


def test_required_columns_of_the_import(spark, tmp_path, names):
    path = write(tmp_path / "g.csv", ROWS[0], ROWS[1])
    good, bad = contract_csv.import_contract_csv(spark, path, *names, first_id=1, required=["Contract", "Term"])
    assert [x["tranid"] for x in good.collect()] == [6]
    assert [x["problems"] for x in bad.collect()] == [["missing Contract"]]
    with pytest.raises(ValueError, match="Colour"):
        contract_csv.import_contract_csv(spark, path, *names, first_id=1, required=["Colour"])


def test_files_with_other_column_order_are_not_mixed_up(spark, tmp_path):
    write(tmp_path / "1.csv", ROWS[0])
    write(tmp_path / "2.csv", "1,3,Bill 3,2 Ines Moreau,Roof tiles,1,5/1/2020,5/31/2020,8.00",
          header="Term,Internal ID,Transaction,Customer,Item,Contract,Start Date,End Date,Total Amount")
    with pytest.raises(Exception, match="(?i)header"):
        contract_csv.read_contract_csv(spark, str(tmp_path)).collect()
    both = contract_csv.read_by_header(spark, [str(tmp_path / "1.csv"), str(tmp_path / "2.csv")])
    assert sorted((x["Transaction"], x["Term"]) for x in both.collect()) == [("Bill 3", "1"), ("Bill 6", "3.5")]


def test_ids_of_appended_files_never_repeat(spark, tmp_path, names):
    table = str(tmp_path / "lines")
    assert tables.next_line_id(spark, table) == 1
    for n in range(3):
        path = write(tmp_path / f"{n}.csv", *ROWS)
        good, _ = contract_csv.import_contract_csv(
            spark, path, *names, first_id=tables.next_line_id(spark, table)
        )
        tables.append_lines(good, table)
    stored = tables.read_table(spark, table, schemas.CONTRACT_LINES)
    assert stored.count() == 6
    assert checks.duplicate_lines(stored).count() == 0
    assert checks.duplicate_lines(stored.union(stored)).count() == 6


def test_table_append_report_and_reset(spark, tmp_path, names):
    table = str(tmp_path / "lines")
    good, _ = contract_csv.import_contract_csv(spark, write(tmp_path / "a.csv", *ROWS), *names, first_id=1)
    tables.append_lines(good, table)
    more = "42,Bill 8,3 Karl Adeyemi,Roof tiles,K-8,2/20/2020,4/30/2020,2.25,90.00"
    good, _ = contract_csv.import_contract_csv(
        spark, write(tmp_path / "b.csv", more), *names, first_id=tables.next_line_id(spark, table)
    )
    tables.append_lines(good, table)
    stored = tables.read_table(spark, table, schemas.CONTRACT_LINES)
    assert stored.count() == 3

    kinds = r.lifecycle(stored, *dimensions(spark)).groupBy("ordertype").count()
    tables.save_report(kinds, str(tmp_path / "kinds"), "csv")
    saved = spark.read.csv(str(tmp_path / "kinds"), header=True)
    assert {x[0]: x[1] for x in saved.collect()} == {"New": "2", "Renewal": "1", "Churn": "2"}

    tables.register_views({"contract_lines": stored})
    maps = tables.row_maps(spark.sql("SELECT tranid AS id FROM contract_lines ORDER BY 1"))
    assert list(maps) == [{"id": 2}, {"id": 6}, {"id": 8}]

    tables.reset_lines(spark, table)
    empty = tables.read_table(spark, table, schemas.CONTRACT_LINES)
    assert empty.count() == 0
    assert r.report_summary(empty, periods_frame(spark, month_rows(2022, 2022))).count() == 0
    tables.append_lines(good, table)
    assert tables.read_table(spark, table, schemas.CONTRACT_LINES).count() == 1


@pytest.fixture
def inbox(spark, tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    lines, rejects = str(tmp_path / "lines"), str(tmp_path / "rejects")
    # The checkpoint folder may outlive the test run.
    progress = f"test_import_{uuid.uuid4()}"

    def run(*names):
        query = import_new_files(spark, str(folder), lines, rejects, *names, name=progress)
        query.awaitTermination(120)
        assert query.exception() is None
        return stored()

    def stored():
        good = tables.read_table(spark, lines, schemas.CONTRACT_LINES).collect()
        bad = spark.read.parquet(rejects).collect()
        assert len({x["line_id"] for x in good}) == len(good)
        return sorted(x["tranid"] for x in good), sorted(x["Transaction"] for x in bad)

    return folder, run, progress


def test_streamed_import_takes_each_file_once(inbox, names):
    folder, run, _ = inbox
    write(folder / "a.csv", *ROWS, "9,Nothing 1,2 Ines Moreau,Roof tiles,1,5/1/2020,5/31/2020,1,1.00")
    assert run(*names) == ([2, 6], ["Nothing 1"])
    assert run(*names) == ([2, 6], ["Nothing 1"])
    # Another order of columns, and no id.
    write(folder / "b.csv", "1,Bill 8,2 Ines Moreau,Roof tiles,1,5/1/2020,5/31/2020,8.00",
          header="Term,Transaction,Customer,Item,Contract,Start Date,End Date,Total Amount")
    assert run(*names) == ([2, 6, 8], ["Nothing 1"])


def test_streamed_rows_are_in_exactly_one_output(spark, inbox, names):
    """A name becomes known between two runs, and a batch is run again after a failure."""
    folder, run, progress = inbox
    transactions, customers, items = names
    known = transactions.union(spark.createDataFrame([(50, "Late 1")], transactions.schema))
    row = "9,Late 1,2 Ines Moreau,Roof tiles,1,5/1/2020,5/31/2020,1,1.00"
    write(folder / "a.csv", ROWS[0], row)
    assert run(*names) == ([6], ["Late 1"])
    # Forget that the batch was committed: it runs again, with the name known by now.
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    commit = root / progress / "stream" / "commits" / "0"
    commit.unlink()
    (commit.parent / ".0.crc").unlink(missing_ok=True)
    assert run(known, customers, items) == ([6], ["Late 1"])
    write(folder / "b.csv", row)
    assert run(known, customers, items) == ([6, 50], ["Late 1"])


def test_duplicate_transactions(spark):
    lines = [line(n, t, 2, 1, "2022-01-01", None, 1, 1) for n, t in enumerate([1, 2, 2, None, None])]
    assert [tuple(x) for x in checks.duplicate_tranids(lines_frame(spark, lines)).collect()] == [(2, 2)]


def test_required_fields(spark):
    lines = [
        line(1, 1, 2, 1, "2022-01-01", "2022-01-31", 1, 1),
        line(2, None, 2, 1, "2022-01-01", None, 1, 1),
    ]
    df = lines_frame(spark, lines)
    whole, lacking = checks.split_required(df, ["tranid", "enddate"])
    assert [x["line_id"] for x in whole.collect()] == [1]
    assert [(x["line_id"], x["missing"]) for x in lacking.collect()] == [(2, ["tranid", "enddate"])]
    whole, lacking = checks.split_required(df)
    assert (whole.count(), lacking.count()) == (2, 0)


def test_dangling_references_become_null(spark):
    transactions, items, customers = dimensions(spark)
    lines = [
        line(1, 3, 2, 1, "2022-01-01", None, 1, 1),
        line(2, 77, 99, None, "2022-01-01", None, 1, 1),
    ]
    df = checks.null_dangling(lines_frame(spark, lines), transactions, customers, items)
    assert df.columns == schemas.CONTRACT_LINES.names
    assert {(x["line_id"], x["tranid"], x["customerid"], x["itemid"]) for x in df.collect()} == {
        (1, 3, 2, 1),
        (2, None, None, None),
    }


def test_repeated_parents_add_no_lines(spark):
    transactions, items, customers = dimensions(spark)
    df = lines_frame(spark, [line(1, 3, 2, 1, "2022-01-01", None, 1, 1)])
    found = checks.null_dangling(df, transactions.union(transactions), customers, items.union(items))
    assert [x["line_id"] for x in found.collect()] == [1]


def test_overlapping_periods(spark):
    rows = month_rows(2022, 2022)
    months = monthly_periods(periods_frame(spark, rows))
    assert months.count() == 12
    assert overlapping_periods(months).count() == 0
    extra = dict(rows[0], id=99, startdate=date(2022, 2, 10), enddate=date(2022, 4, 1))
    found = overlapping_periods(monthly_periods(periods_frame(spark, [*rows, extra])))
    assert sorted(x["periodid"] for x in found.collect()) == [3, 4, 99]
