"""The reports over plain Python rows, straight from their definition.

Quadratic and exact; only for small fixtures.
"""

from __future__ import annotations

import calendar
import math
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

CENT = Decimal("0.01")


def rounded(value):
    return value.quantize(CENT, ROUND_HALF_UP)


def shifted(day, months):
    count = day.year * 12 + day.month - 1 + months
    year, month = divmod(count, 12)
    last = calendar.monthrange(year, month + 1)[1]
    at_end = day.day == calendar.monthrange(day.year, day.month)[1]
    return date(year, month + 1, last if at_end else min(day.day, last))


def nulls_last(*values):
    return tuple((v is None, v if v is not None else 0) for v in values)


def rate(line):
    if line["tranid"] is None or line["amount"] is None or not line["term"]:
        return None
    return rounded(line["amount"] / line["term"])


def typed(lines):
    """Lines with previous contract, gaps and order type."""
    out = []
    groups = defaultdict(list)
    for line in lines:
        groups[line["customerid"], line["itemid"]].append(line)
    for (customer, item), group in groups.items():
        far = date.max
        group = sorted(
            group,
            key=lambda x: (
                x["enddate"] or far,
                x["startdate"] or far,
                x["tranid"] is None,
                x["tranid"] or 0,
                x["line_id"],
            ),
        )
        for at, line in enumerate(group):
            start, end = line["startdate"], line["enddate"]
            ended = [
                x["enddate"] for x in group if x["enddate"] and start and x["enddate"] < start
            ]
            known = customer is not None and item is not None
            previous = max(ended) if ended and known else None
            names = [x["tranid"] for x in group if x["enddate"] == previous and x["tranid"] is not None]
            before = group[at - 1]["enddate"] if at else None
            after = group[at + 1]["startdate"] if at + 1 < len(group) else None
            gap_before = (start - before).days if start and before else None
            gap_after = (after - end).days if after and end else None
            broken = gap_before is not None and gap_before > 1 and known and end is not None
            out.append(
                {
                    **line,
                    "previousenddate": previous,
                    "previoustranid": max(names) if previous and names else None,
                    "gapwithprevious": gap_before,
                    "gapwithnext": gap_after,
                    "ordertype": "Renewal" if previous and not broken else "New",
                }
            )
    return out


def churns(rows):
    for row in rows:
        if row["gapwithnext"] is None or row["gapwithnext"] > 1:
            day = row["enddate"] + timedelta(1) if row["enddate"] else None
            yield row, day


def longest(lines):
    terms = [x["term"] for x in lines if x["term"] is not None]
    return max(1, math.floor(max(terms))) if terms else 1


def month_numbers(line, lines, truncated=False, between=None):
    if line["tranid"] is None or line["term"] is None:
        return []
    count = math.ceil(line["term"])
    if truncated:
        count = min(count, longest(lines))
    numbers = range(1, count + 1)
    if between is None:
        return list(numbers)
    low, high = map(date.fromisoformat, between)
    return [
        k
        for k in numbers
        if line["startdate"] and low <= shifted(line["startdate"], k - 1) <= high
    ]


def month_amount(line, k):
    each = rate(line)
    if each is None:
        return None
    left = rounded(line["amount"] - math.trunc(line["term"]) * each)
    return left if k > line["term"] else left + each if k == line["term"] else each


def holding(day, periods):
    """Month periods around a day, or one empty period."""
    found = [
        p
        for p in periods
        if day and p["isquarter"] == p["isyear"] == "F" and p["startdate"] <= day <= p["enddate"]
    ]
    return found or [{"id": None, "periodname": None, "startdate": None}]


def monthly(lines, periods, truncated=False):
    out = []
    for line in lines:
        for k in month_numbers(line, lines, truncated) or [None]:
            day = shifted(line["startdate"], k - 1) if k and line["startdate"] else None
            for p in holding(day, periods):
                out.append(
                    (line["tranid"], line["term"], line["amount"], p["startdate"], p["id"],
                     p["periodname"], month_amount(line, k) if k else None)
                )
    return out


def detail(lines, periods, truncated=False, between=None):
    """(tranid, customerid, itemid, type, previous, period id, period, mrr)"""
    rows = typed(lines)
    out = []
    for row in rows:
        for k in month_numbers(row, lines, truncated, between) or [None]:
            day = shifted(row["startdate"], k - 1) if k and row["startdate"] else None
            for p in holding(day, periods):
                out.append(
                    (row["tranid"], row["customerid"], row["itemid"], row["ordertype"],
                     row["previoustranid"], p["id"], p["periodname"],
                     month_amount(row, k) if k else None)
                )
    for row, day in churns(rows):
        for p in holding(day, periods):
            out.append(
                (None, row["customerid"], row["itemid"], "Churn", row["tranid"], p["id"],
                 p["periodname"], rate(row))
            )
    return out


def summary(rows, periods, between=None):
    """(period, type, mrr) from detail rows."""
    shown = {p["id"]: p for p in periods}
    if between:
        low, high = map(date.fromisoformat, between)
        shown = {k: p for k, p in shown.items() if low <= p["startdate"] <= high}
    sums = {}
    for *_, kind, _previous, period, _name, mrr in rows:
        if period in shown:
            total = sums.get((period, kind))
            if mrr is not None:
                total = mrr if total is None else total + mrr
            sums[period, kind] = total
    return [(shown[p]["periodname"], kind, total) for (p, kind), total in sums.items()]
