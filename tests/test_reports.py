from __future__ import annotations

from collections import Counter
from datetime import date
from decimal import Decimal

import pytest

from renewline.operators import lifecycle as lc
from renewline.operators import timeline as t
from renewline.operators.periods import monthly_periods
from renewline.operators.schedule import expand_term, period_numbers
from renewline.plans import reports as r
from tests import brute
from tests.fixtures import (
    dimensions,
    line,
    lines_frame,
    month_rows,
    periods_frame,
    random_lines,
)

#: Five whole months, and two and a half; then the first is renewed by an odd amount.
BEFORE = [
    line(5, 7, 3, 1, "2021-02-01", "2021-06-30", 5, "731.25"),
    line(6, 2, 2, 2, "2021-05-01", "2021-07-15", "2.5", "400.00"),
]
AFTER = [*BEFORE, line(9, 8, 3, 1, "2021-07-01", "2021-08-31", 2, "301.01")]
PERIODS = month_rows(2021, 2024)


def D(text):
    return Decimal(text)


@pytest.fixture(scope="module")
def dims(spark):
    return dimensions(spark)


@pytest.fixture(scope="module")
def periods(spark):
    return periods_frame(spark, PERIODS).cache()


def detail(spark, lines, periods, dims, **options):
    rows = r.lifecycle_mrr(lines_frame(spark, lines), periods, *dims, **options).collect()
    return [
        (x["tranid"], x["item"], x["ordertype"], x["previoustranid"], x["postingperiod"], x["mrr"])
        for x in rows
    ]


def months(names, *row):
    return [(*row[:-1], f"{name} 2021", row[-1]) for name in names.split()]


FIRST = months("Feb Mar Apr May Jun", 7, "GT-1", "New", None, D("146.25"))
SECOND = [
    *months("May Jun", 2, "RT-2", "New", None, D("160.00")),
    *months("Jul", 2, "RT-2", "New", None, D("80.00")),
    (None, "RT-2", "Churn", 2, "Jul 2021", D("160.00")),
]


def test_detail_before_the_renewal(spark, periods, dims):
    assert detail(spark, BEFORE, periods, dims) == [
        *FIRST,
        (None, "GT-1", "Churn", 7, "Jul 2021", D("146.25")),
        *SECOND,
    ]


def test_detail_after_the_renewal(spark, periods, dims):
    assert detail(spark, AFTER, periods, dims) == [
        *FIRST,
        *months("Jul", 8, "GT-1", "Renewal", 7, D("150.51")),
        *months("Aug", 8, "GT-1", "Renewal", 7, D("150.50")),
        (None, "GT-1", "Churn", 8, "Sep 2021", D("150.51")),
        *SECOND,
    ]


def test_summary_of_both_states(spark, periods):
    def summary(lines):
        return [tuple(x) for x in r.report_summary(lines_frame(spark, lines), periods).collect()]

    until_june = [
        *((f"{name} 2021", "New", D("146.25")) for name in ("Feb", "Mar", "Apr")),
        *((f"{name} 2021", "New", D("306.25")) for name in ("May", "Jun")),
    ]
    assert summary(BEFORE) == [
        *until_june,
        ("Jul 2021", "Churn", D("306.25")),
        ("Jul 2021", "New", D("80.00")),
    ]
    assert summary(AFTER) == [
        *until_june,
        ("Jul 2021", "Churn", D("160.00")),
        ("Jul 2021", "New", D("80.00")),
        ("Jul 2021", "Renewal", D("150.51")),
        ("Aug 2021", "Renewal", D("150.50")),
        ("Sep 2021", "Churn", D("150.51")),
    ]


def test_monthly_schedule(spark, periods, dims):
    rows = r.monthly_mrr(lines_frame(spark, BEFORE), periods, dims[0]).collect()
    assert [x["mrr"] for x in rows] == [D("160.00")] * 2 + [D("80.00")] + [D("146.25")] * 5
    assert tuple(rows[0]) == ("B-2", D("2.5"), D("400.00"), date(2021, 5, 1), 5, "May 2021", D("160.00"))


def test_previous_transactions(spark, dims):
    transactions, items, customers = dims
    rows = r.previous_transaction(lines_frame(spark, AFTER), customers, transactions, items)
    assert [(x[0], x["previousenddate"], x["previoustranid"]) for x in rows.collect()] == [
        (2, None, None),
        (7, None, None),
        (8, date(2021, 6, 30), 7),
    ]
    assert tuple(rows.first())[1:4] == ("B-2", "Ines Moreau", "RT-2")


def test_display_values_and_names(spark, periods, dims):
    """References are shown by their display value, names where a report names them."""
    df = lines_frame(spark, BEFORE)
    assert {(x["transaction"], x["item"]) for x in r.lifecycle(df, *dims).collect()} == {
        ("Bill 7", "Garden tools"), ("Bill 2", "Roof tiles"), (None, "Garden tools"), (None, "Roof tiles"),
    }
    shown = r.lifecycle_mrr(df, periods, *dims).where("transaction is not null").collect()
    assert {(x["transaction"], x["item"]) for x in shown} == {("Bill 7", "GT-1"), ("Bill 2", "RT-2")}


def test_unknown_customers_are_left_out_of_previous_transactions_only(spark, periods, dims):
    transactions, items, customers = dims
    df = lines_frame(spark, [line(1, 3, 99, 1, "2022-01-01", "2022-01-31", 1, 10)])
    assert r.previous_transaction(df, customers, transactions, items).count() == 0
    assert r.lifecycle(df, *dims).count() == 2
    assert r.lifecycle_mrr(df, periods, *dims).count() == 2


@pytest.mark.parametrize(
    ("lines", "kinds"),
    [(BEFORE, {"New": 2, "Churn": 2}), (AFTER, {"New": 2, "Renewal": 1, "Churn": 2})],
)
def test_order_type_report(spark, dims, lines, kinds):
    rows = r.lifecycle(lines_frame(spark, lines), *dims).collect()
    assert Counter(x["ordertype"] for x in rows) == kinds
    churned = [x for x in rows if x["ordertype"] == "Churn"]
    assert {(x["transactionid"], x["transaction"], x["previoustranid"]) for x in churned} == {
        (None, None, None)
    }
    places = [(x["customer"], x["item"], x["startdate"]) for x in rows]
    assert places == sorted(places)


def test_names(spark, periods, dims):
    lines = [
        line(1, 1, 4, 1, "2022-01-01", "2022-01-31", 1, 10),
        line(2, 2, 5, 2, "2022-01-01", "2022-01-31", 1, 10),
    ]
    df = lines_frame(spark, lines)
    by_type = {x["transactionid"]: x["customer"] for x in r.lifecycle(df, *dims).collect()}
    assert (by_type[1], by_type[2]) == (" X", "Old Name")
    in_detail = {x["tranid"]: x["customer"] for x in r.lifecycle_mrr(df, periods, *dims).collect()}
    assert (in_detail[1], in_detail[2]) == (" X", "Brick & Co")


def test_every_month_counts_unless_truncated(spark, periods, dims):
    short = line(1, 1, 2, 1, "2022-01-01", "2022-04-15", "3.5", 1000)
    year = line(2, 2, 3, 2, "2022-01-01", "2022-12-31", 12, 100)
    whole = [x for x in detail(spark, [short], periods, dims) if x[0] == 1]
    assert [x[-1] for x in whole] == [D("285.71")] * 3 + [D("142.87")]
    cut = detail(spark, [short], periods, dims, truncated=True)
    assert [x[-1] for x in cut if x[0] == 1] == [D("285.71")] * 3
    assert cut[-1] == (None, "GT-1", "Churn", 1, "Apr 2022", D("285.71"))
    both = detail(spark, [short, year], periods, dims, truncated=True)
    assert [x[-1] for x in both if x[0] == 1] == [D("285.71")] * 3 + [D("142.87")]
    assert [x[-1] for x in both if x[0] == 2] == [D("8.33")] * 11 + [D("8.37")]


def test_extreme_amounts_cost_their_own_line_only(spark, periods, dims):
    lines = [
        line(1, 1, 2, 1, "2022-01-01", "2022-01-31", "0.000001", "9999999999999999.99"),
        line(2, 2, 3, 2, "2022-01-01", "2022-02-28", 2, "9999999999999999.99"),
        line(3, 3, 3, 1, "2022-01-01", "2022-01-31", "-0.000001", "-9999999999999999.99"),
        line(4, 4, 4, 1, "2022-01-01", "2022-01-31", 1, 10),
        line(5, 5, 4, 2, "2022-01-01", "2022-01-31", "0.999999", "9999999999999999.99"),
    ]
    rows = detail(spark, lines, periods, dims)
    shown = {x[0]: [y[-1] for y in rows if y[0] == x[0]] for x in rows if x[0]}
    assert shown[1] == [D("9999999999999999.99")]
    assert shown[2] == [D("5000000000000000.00"), D("4999999999999999.99")]
    assert shown[4] == [D("10.00")]
    churned = {x[3]: x[-1] for x in rows if x[2] == "Churn"}
    assert (churned[1], churned[3], churned[4]) == (None, None, D("10.00"))
    df = lines_frame(spark, lines)
    assert r.report_summary(df, periods).count() > 0
    assert r.monthly_mrr(df, periods, dims[0]).count() == 6


def test_period_numbers(spark):
    def numbers(*terms):
        lines = [line(n, n, 2, 1, "2022-01-01", None, term, 1) for n, term in enumerate(terms)]
        return [x[0] for x in period_numbers(lines_frame(spark, lines)).orderBy("period").collect()]

    assert numbers(3, "4.75") == [1, 2, 3, 4]
    assert numbers("0.5") == [1]
    assert numbers(None) == [1]


def test_no_expansion_without_positive_term_or_transaction(spark, periods, dims):
    lines = [
        line(1, 1, 2, 1, "2022-01-01", "2022-01-31", None, 10),
        line(2, 2, 3, 1, "2022-01-01", "2022-01-31", 0, 10),
        line(3, 6, 4, 1, "2022-01-01", "2022-01-31", -2, 10),
        line(4, None, 5, 1, "2022-01-01", "2022-03-31", 3, 30),
    ]
    df = lines_frame(spark, lines)
    assert [tuple(x)[3:] for x in r.monthly_mrr(df, periods, dims[0]).collect()] == [(None,) * 4] * 4
    assert expand_term(df).select("id").collect() == [(None,)] * 3
    rows = detail(spark, lines, periods, dims)
    assert Counter(x[-2:] for x in rows if x[2] != "Churn") == {(None, None): 4}
    churned = {x[3]: x[-2:] for x in rows if x[2] == "Churn"}
    assert churned == {
        1: ("Feb 2022", None),
        2: ("Feb 2022", None),
        6: ("Feb 2022", D("-5.00")),
        None: ("Apr 2022", None),
    }


def test_months_without_period_stay_in_detail_only(spark, periods, dims):
    periods = periods.where("startdate < '2024-01-01'")
    lines = [line(1, 1, 2, 1, "2023-12-01", "2024-01-31", 2, 20)]
    assert [x[-2:] for x in detail(spark, lines, periods, dims)] == [
        ("Dec 2023", D("10.00")),
        (None, D("10.00")),
        (None, D("10.00")),
    ]
    summary = r.report_summary(lines_frame(spark, lines), periods).collect()
    assert [tuple(x) for x in summary] == [("Dec 2023", "New", D("10.00"))]


def test_overlapping_periods_repeat_rows(spark, dims):
    extra = dict(PERIODS[0], id=99, periodname="Adjust 2022", startdate=date(2022, 1, 1),
                 enddate=date(2022, 2, 5))
    both = periods_frame(spark, [*PERIODS, extra])
    lines = [line(1, 1, 2, 1, "2022-01-03", "2022-03-02", 2, 20)]
    rows = detail(spark, lines, both, dims)
    assert Counter(x[-2] for x in rows if x[0] == 1) == {
        "Jan 2022": 1, "Feb 2022": 1, "Adjust 2022": 2,
    }


def test_month_end_starts_stay_at_month_end(spark, dims):
    late = dict(PERIODS[0], id=1, periodname="Late", startdate=date(2022, 3, 31), enddate=date(2022, 4, 1))
    lines = [line(1, 1, 2, 1, "2022-02-28", "2022-04-27", 2, 20)]
    rows = detail(spark, lines, periods_frame(spark, [late]), dims)
    assert [x[-2] for x in rows if x[0] == 1] == [None, "Late"]


def test_period_longer_than_centuries(spark, dims):
    ever = dict(PERIODS[0], startdate=date(1, 1, 1), enddate=date(9999, 12, 31), periodname="Ever")
    rows = detail(spark, BEFORE, periods_frame(spark, [ever]), dims)
    assert {x[-2] for x in rows} == {"Ever"}


def test_filters(spark, periods, dims):
    whole = detail(spark, AFTER, periods, dims)
    july = [x for x in whole if x[-2] == "Jul 2021"]
    assert len(july) == 3
    assert detail(spark, AFTER, periods, dims, churn_period=7) == [x for x in july if x[2] == "Churn"]
    for kind in ("New", "Renewal"):
        assert detail(spark, AFTER, periods, dims, period=7, ordertype=kind) == [
            x for x in july if x[2] == kind
        ]
    assert detail(spark, AFTER, periods, dims, period=8, ordertype="Renewal") == [
        x for x in whole if x[-2] == "Aug 2021"
    ]
    assert detail(spark, AFTER, periods, dims, period=7, ordertype="Churn") == []
    assert detail(spark, AFTER, periods, dims, period=12345) == []
    assert detail(spark, AFTER, periods, dims, ordertype="Churn") == [
        x for x in whole if x[2] == "Churn"
    ]
    with pytest.raises(ValueError, match="not both"):
        detail(spark, AFTER, periods, dims, period=7, churn_period=7)


def test_month_window_keeps_contracts_outside_it(spark, periods, dims):
    rows = detail(spark, BEFORE, periods, dims, between=("2021-03-01", "2021-04-01"))
    assert [x for x in rows if x[2] == "New"] == [
        *months("Mar Apr", 7, "GT-1", "New", None, D("146.25")),
        (2, "RT-2", "New", None, None, None),
    ]


def test_summary_window(spark, periods):
    df = lines_frame(spark, AFTER)
    whole = r.report_summary(df, periods).collect()
    shown = r.report_summary(df, periods, between=("2021-04-01", "2021-07-15")).collect()
    assert shown == whole[2:8]


def random_setup(spark, seed):
    lines = random_lines(seed, 250, customers=5, missing=0.04)
    rows = month_rows(2020, 2021)
    odd = dict(rows[5], id=500, periodname="Odd", startdate=date(2020, 6, 10), enddate=date(2020, 8, 9))
    rows.append(odd)
    return lines, rows, lines_frame(spark, lines), periods_frame(spark, rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_reports_equal_definition(spark, dims, seed):
    lines, rows, df, periods = random_setup(spark, seed)
    truncated = [True, False, True][seed]
    between = [None, None, ("2020-03-15", "2020-11-20")][seed]
    hot = [None, df.select(*t.KEY).distinct(), None][seed]

    want = brute.monthly(lines, rows, truncated)
    got = r.monthly_mrr(df, periods, dims[0], truncated=truncated)
    assert Counter(x[1:] for x in want) == Counter(tuple(x)[1:] for x in got.collect())

    want = brute.detail(lines, rows, truncated, between)
    got = r.report_drilldown(df, periods, between=between, truncated=truncated, hot=hot).collect()
    assert Counter((x[3], x[5], x[6], x[7]) for x in want) == Counter(map(tuple, got))
    got = r.lifecycle_mrr(df, periods, *dims, between=between, truncated=truncated, hot=hot).collect()
    assert Counter((x[0], x[3], x[4], x[6], x[7]) for x in want) == Counter(
        (x["tranid"], x["ordertype"], x["previoustranid"], x["postingperiod"], x["mrr"]) for x in got
    )

    got = r.report_summary(df, periods, months_between=between, truncated=truncated, hot=hot).collect()
    assert Counter(brute.summary(want, rows)) == Counter(map(tuple, got))
    window = ("2020-02-01", "2020-09-30")
    got = r.report_summary(
        df, periods, between=window, months_between=between, truncated=truncated, hot=hot
    ).collect()
    assert Counter(brute.summary(want, rows, window)) == Counter(map(tuple, got))


def test_unions_equal_definition(spark):
    lines, rows, df, periods = random_setup(spark, 7)
    typed = t.order_types(df, hot=None)
    months = monthly_periods(periods)
    contracts = brute.typed(lines)
    ended = list(brute.churns(contracts))

    def own(x):
        return (x["tranid"], x["customerid"], x["itemid"], x["startdate"], x["enddate"], x["ordertype"],
                x["previoustranid"])

    want = [own(x) for x in contracts]
    gone = [(None, x["customerid"], x["itemid"], day, day, "Churn", None) for x, day in ended]
    assert Counter(map(tuple, lc.lifecycle_union(typed).collect())) == Counter(want + gone)
    assert Counter(map(tuple, lc.churns(typed).collect())) == Counter(x[1:6] for x in gone)

    posted = [
        (None, x["customerid"], x["itemid"], day, day, "Churn", x["tranid"], p["periodname"], p["id"],
         brute.rate(x))
        for x, day in ended
        for p in brute.holding(day, rows)
    ]
    plain = [(*x, None, None, D("0.00")) for x in want]
    got = lc.lifecycle_union_mrr(typed, months).collect()
    assert Counter(map(tuple, got)) == Counter(plain + posted)
    got = lc.churns_mrr(typed, months).collect()
    assert Counter(map(tuple, got)) == Counter((x[6], *x[1:6], *x[7:]) for x in posted)


def test_months_add_up_to_the_amount(spark, dims, periods):
    lines = [x for x in random_lines(21, 300, missing=0) if x["term"] > 0]
    rows = r.monthly_mrr(lines_frame(spark, lines), periods.limit(0), dims[0])
    total = rows.agg({"mrr": "sum"}).first()[0]
    assert total == sum(x["amount"] for x in lines)


def test_reports_are_ordered(spark, dims):
    lines, rows, df, periods = random_setup(spark, 5)
    _, items, customers = dims
    numbers = df.where("tranid is not null").selectExpr(
        "tranid as id", "lpad(tranid, 5, '0') as trandisplayname", "lpad(tranid, 5, '0') as display"
    )
    people = customers.unionByName(
        spark.createDataFrame([(n, "A", "B", "T", None) for n in (0, 1)], customers.schema)
    )
    first = {p["periodname"]: p["startdate"] for p in rows if p["isquarter"] == p["isyear"] == "F"}

    def in_order(keys):
        keys = [brute.nulls_last(*k) for k in keys]
        assert len(keys) > 50
        assert keys == sorted(keys)

    got = r.monthly_mrr(df, periods, numbers).collect()
    posted = [x for x in got if x["mrr"] is not None and x["postingperiod"] not in (None, "Odd")]
    in_order((x["transaction"], x["startdate"]) for x in posted)
    empty = [n for n, x in enumerate(got) if x["mrr"] is None and x["startdate"] is None]
    assert empty[-1] == len(got) - 1

    got = r.previous_transaction(df, people, numbers, items).collect()
    in_order((x["transactionid"],) for x in got)

    place = {x["tranid"]: (x["customerid"], x["itemid"]) for x in lines if x["tranid"] is not None}
    got = [x for x in r.lifecycle(df, numbers, items, people).collect() if x["transactionid"]]
    in_order((*place[x["transactionid"]], x["startdate"]) for x in got)

    got = [x for x in r.lifecycle_mrr(df, periods, numbers, items, people).collect() if x["tranid"]]
    start = {x["tranid"]: x["startdate"] for x in lines}
    in_order(
        (place[x["tranid"]][1], start[x["tranid"]], first.get(x["postingperiod"])) for x in got
        if start[x["tranid"]] and x["postingperiod"] not in (None, "Odd")
    )

    got = r.report_summary(df, periods).collect()
    in_order((first[x["period"]], x["ordertype"]) for x in got)
