"""Small tables and random contract lines."""

from __future__ import annotations

import calendar
import random
from datetime import date, timedelta
from decimal import Decimal

from renewline.sources import schemas

NAMES = schemas.CONTRACT_LINES.names


def line(line_id, tranid, customerid, itemid, start, end, term, amount):
    def day(text):
        return date.fromisoformat(text) if text else None

    def number(value):
        return Decimal(str(value)) if value is not None else None

    values = (line_id, tranid, customerid, itemid, str(line_id), day(start), day(end), number(term),
              number(amount))
    return dict(zip(NAMES, values, strict=True))


def lines_frame(spark, lines):
    return spark.createDataFrame([tuple(x[c] for c in NAMES) for x in lines], schemas.CONTRACT_LINES)


def month_rows(first_year, last_year):
    """Months numbered from 1, plus quarters and years."""
    rows = []
    for year in range(first_year, last_year + 1):
        for month in range(1, 13):
            last = calendar.monthrange(year, month)[1]
            rows.append(
                (len(rows) + 1, f"{calendar.month_abbr[month]} {year}", date(year, month, 1),
                 date(year, month, last), "F", "F")
            )
    others = []
    for year in range(first_year, last_year + 1):
        for quarter in range(4):
            month = quarter * 3 + 3
            others.append(
                (1000 + len(others), f"Q{quarter + 1} {year}", date(year, month - 2, 1),
                 date(year, month, calendar.monthrange(year, month)[1]), "T", "F")
            )
        others.append((1000 + len(others), f"FY {year}", date(year, 1, 1), date(year, 12, 31), "F", "T"))
    return [dict(zip(schemas.ACCOUNTING_PERIODS.names, r, strict=True)) for r in rows + others]


def periods_frame(spark, rows):
    names = schemas.ACCOUNTING_PERIODS.names
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], schemas.ACCOUNTING_PERIODS)


CUSTOMERS = [
    (2, "Ines", "Moreau", "T", None),
    (3, "Karl", "Adeyemi", "T", None),
    (4, None, "X", "T", None),
    (5, "Old", "Name", "F", "Brick & Co"),
]
ITEMS = [(1, "Garden tools", "GT-1"), (2, "Roof tiles", "RT-2")]
TRANSACTIONS = [(n, f"Bill {n}", f"B-{n}") for n in range(1, 10)]


def dimensions(spark):
    """Transactions, items and customers."""
    return (
        spark.createDataFrame(TRANSACTIONS, schemas.TRANSACTIONS),
        spark.createDataFrame(ITEMS, schemas.ITEMS),
        spark.createDataFrame(CUSTOMERS, schemas.CUSTOMERS),
    )


def random_lines(seed, count, customers=4, days=500, missing=0.06):
    """Overlaps, ties, same-day starts, gaps and missing values of every kind."""
    rng = random.Random(seed)

    def maybe(value):
        return None if rng.random() < missing else value

    ids = list(range(1, count + 1))
    rng.shuffle(ids)
    out = []
    for n in range(count):
        start = date(2020, 1, 1) + timedelta(rng.randrange(days))
        if rng.random() < 0.5:
            start = start.replace(day=1)
        if rng.random() < 0.1:
            start = start.replace(day=calendar.monthrange(start.year, start.month)[1])
        end = start + timedelta(rng.choice([0, 14, 29, 30, 89, 90, 180]))
        term = rng.choice(["1", "3", "6", "3.5", "0.5", "2.25", "0", "-1", "0.333333"])
        amount = Decimal(rng.randrange(-20000, 500000)) / 100
        out.append(
            {
                "line_id": n,
                "tranid": maybe(ids[n]),
                "customerid": maybe(rng.randrange(customers)),
                "itemid": maybe(rng.randrange(2)),
                "contractid": str(n),
                "startdate": maybe(start),
                "enddate": maybe(end),
                "term": maybe(Decimal(term)),
                "amount": maybe(amount),
            }
        )
    return out
