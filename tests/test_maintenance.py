"""Stored timelines and summaries after appends, against the full run."""

from __future__ import annotations

import random
import re
from collections import Counter
from datetime import date, timedelta

import pytest

import __spark_entry__ as entry
from renewline.operators import maintenance, timeline
from renewline.operators.skew import hot_keys
from renewline.plans import reports
from renewline.sources.files import FileSystem
from renewline.sources.timeline_store import TYPED, TimelineStore
from tests.fixtures import line, lines_frame, month_rows, periods_frame


def random_lines(rng: random.Random, first: int, count: int):
    out = []
    for i in range(first, first + count):
        start = date(2020, 1, 1) + timedelta(days=rng.randrange(600))
        term = rng.choice([1, 2, 3, 3.5, 0.5, 12, None, 0, -1])
        end = start + timedelta(days=rng.randrange(150))
        out.append(
            line(
                i, rng.choice([i, i, i, None, i - 1]), rng.choice([1, 2, 3, 4, None]), rng.choice([1, 2, 2, None]),
                rng.choice([start.isoformat()] * 9 + [None]), rng.choice([end.isoformat()] * 9 + [None]), term,
                rng.choice([rng.randrange(10_000) / 100] * 6 + [None]),
            )
        )
    # Some ids stand for two lines of a batch.
    return out + rng.sample(out, min(2, len(out)))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def typed_columns():
    return [c for c in TYPED.names if c not in ("firstday", "lastday")]


@pytest.fixture
def periods(spark):
    return periods_frame(spark, month_rows(2019, 2023))


def test_ten_appends_equal_the_full_run(spark, tmp_path, periods):
    rng = random.Random(3)
    store = TimelineStore(spark, str(tmp_path / "store"), buckets=4)
    every = []
    for n in range(10):
        batch = random_lines(rng, 100 * n, rng.choice([1, 5, 12]))
        every += batch
        store.append(lines_frame(spark, batch), periods, f"batch-{n}", hot=None)
        lines = lines_frame(spark, every)
        want = timeline.order_types(lines, hot=None).select(*typed_columns())
        assert rows(store.lines().select(*typed_columns())) == rows(want), n
        assert rows(store.summary()) == rows(reports.report_summary(lines, periods, hot=None)), n
    window = ("2020-03-01", "2020-09-30")
    assert rows(store.summary_between(periods, window)) == rows(reports.report_summary(lines, periods, window, hot=None))


def test_appends_that_find_big_timelines_equal_the_full_run(spark, tmp_path, periods, monkeypatch):
    found = []

    def search(lines):
        found.append(hot_keys(lines, timeline.KEY, hot_rows=6))
        return found[-1]

    monkeypatch.setattr(maintenance, "hot_timelines", search)
    rng = random.Random(8)
    store = TimelineStore(spark, str(tmp_path / "store"), buckets=4)
    every = []
    for n, count in enumerate((3, 60, 5, 1)):
        batch = random_lines(rng, 100 * n, count)
        every += batch
        store.append(lines_frame(spark, batch), periods, f"batch-{n}")
        lines = lines_frame(spark, every)
        want = timeline.order_types(lines, hot=None).select(*typed_columns())
        assert rows(store.lines().select(*typed_columns())) == rows(want), n
        assert rows(store.summary()) == rows(reports.report_summary(lines, periods, hot=None)), n
    big = [{tuple(r) for r in f.collect()} if f else set() for f in found]
    assert not big[0] and any(None in key for key in big[2])
    # The last batch touches a timeline or none of the big ones; others stay where they are.
    kept, inside = maintenance.touched(store.lines(), lines_frame(spark, batch), found[-1])
    touched = {(x["customerid"], x["itemid"]) for x in batch}
    assert {(r.customerid, r.itemid) for r in inside.collect()} == touched
    assert big[-1] - touched <= {(r.customerid, r.itemid) for r in kept.collect()}
    assert kept.count() + inside.count() == len(every)


def test_maintained_queries_search_for_big_timelines(spark, monkeypatch):
    found = []

    def search(lines):
        found.append(hot_keys(lines, timeline.KEY, hot_rows=100))
        return found[-1]

    monkeypatch.setattr(maintenance, "hot_timelines", search)
    got = entry.own_queries()["maintained_summary"](spark, "/root/testdata/sf0.001")
    assert len(found) == 4 and all(found)
    assert rows(got) == rows(entry.own_queries()["report_summary_hard"](spark, "/root/testdata/sf0.001"))


def test_a_batch_run_again_changes_nothing(spark, tmp_path, periods, monkeypatch):
    rng = random.Random(4)
    store = TimelineStore(spark, str(tmp_path / "store"), buckets=3)
    first, second = (lines_frame(spark, random_lines(rng, 100 * n, 20)) for n in range(2))
    store.append(first, periods, "a", hot=None)

    # Lost after the change was written, before any folder was replaced.
    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("renewline.sources.timeline_store.touched", lost)
        with pytest.raises(RuntimeError):
            store.append(second, periods, "b", hot=None)
    # Or with some of the folders replaced.
    partly = second.where("customerid = 1")
    before = FileSystem(spark, store.path).names(f"{store.path}/changes")
    store.append(partly, periods, "b", hot=None)
    for _ in range(2):
        store.append(second, periods, "b", hot=None)
    both = first.unionByName(second)
    assert FileSystem(spark, store.path).names(f"{store.path}/changes") == before == ["a", "b"]
    assert rows(store.lines().select(*typed_columns())) == rows(timeline.order_types(both, hot=None).select(*typed_columns()))
    assert rows(store.summary()) == rows(reports.report_summary(both, periods, hot=None))


def test_only_touched_folders_are_written(spark, tmp_path, periods):
    store = TimelineStore(spark, str(tmp_path / "store"), buckets=16)
    lines = [line(i, i, i, 1, "2020-01-01", "2020-03-31", 3, 30) for i in range(200)]
    store.append(lines_frame(spark, lines), periods, "a", hot=None)
    fs = FileSystem(spark, store.path)
    files = lambda: {b: fs.names(f"{store.path}/typed/{b}") for b in fs.names(f"{store.path}/typed") if b[0] == "b"}
    before = files()
    store.append(lines_frame(spark, [line(500, 500, 7, 1, "2020-04-01", "2020-06-30", 3, 30)]), periods, "b", hot=None)
    after = files()
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    assert {r.ordertype for r in store.lines().where("line_id = 500").collect()} == {"Renewal"}
    store.append(lines_frame(spark, []), periods, "c", hot=None)
    assert files() == after


def test_the_plan_semi_joins_the_stored_lines(spark, tmp_path, periods):
    store = TimelineStore(spark, str(tmp_path / "store"), buckets=4)
    store.append(lines_frame(spark, random_lines(random.Random(1), 0, 30)), periods, "a", hot=None)
    batch = lines_frame(spark, random_lines(random.Random(2), 100, 3))
    before, _ = maintenance.reorder(store.lines(), batch, hot=None)
    assert "LeftSemi" in before._jdf.queryExecution().optimizedPlan().toString()


def test_windows_filter_the_files(spark, tmp_path, periods):
    store = TimelineStore(spark, str(tmp_path / "store"), buckets=2)
    store.append(lines_frame(spark, random_lines(random.Random(5), 0, 60)), periods, "a", hot=None)
    read = store.posting_between(periods, ("2020-05-01", "2020-05-31"))
    explain = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    plan = explain(read._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan)[1]
    assert "LessThanOrEqual(firstday," in pushed and "GreaterThanOrEqual(lastday," in pushed
    assert 0 < read.count() < store.lines().count()


def test_an_empty_store(spark, tmp_path, periods):
    store = TimelineStore(spark, str(tmp_path / "store"))
    assert store.lines().count() == store.summary().count() == 0
    assert store.summary_between(periods, ("2020-05-01", "2020-05-31")).count() == 0


def test_changes_cancel_where_nothing_changes(spark, periods):
    lines = lines_frame(spark, random_lines(random.Random(6), 0, 40))
    typed = timeline.order_types(lines, hot=None)
    assert reports.summary_changes(typed, typed, periods).count() == 0
    gone = reports.summary_changes(typed.where("false"), typed, periods).unionByName(
        reports.summary_changes(typed, typed.where("false"), periods)
    )
    assert reports.summary_after(gone).count() == 0
