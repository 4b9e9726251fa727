"""Registered queries and their reference SQL.

Contract lines are derived from the orders (see ``renewline.sources.orders``);
the SQL derives them by the same rule. Money is computed in whole cents there.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from renewline.operators import checks, lifecycle, periods, schedule, timeline  # noqa: E402
from renewline.plans import reports  # noqa: E402
from renewline.sources import contract_csv, files, ledger, orders, schemas, tables  # noqa: E402
from renewline.sources.timeline_store import TimelineStore  # noqa: E402


def _optional(name: str):
    """A module of the part that can be left out, or None where it is. Other missing modules are errors."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        if error.name not in ("renewline.llm", "renewline.llm.queries", "corpus_pipeline"):
            raise
        return None


llm_queries = _optional("renewline.llm.queries")
corpus_pipeline = _optional("corpus_pipeline")

CHURN_PERIOD = 199806
ORDER_PERIOD = 199903
MONTH_WINDOW = ("1997-01-15", "1997-12-20")
SUMMARY_WINDOW = ("1998-01-01", "1998-12-31")


def entry(spark: SparkSession) -> DataFrame:
    return _report_summary(spark, "/root/testdata/sf0.001")


def _months(spark: SparkSession, d: str) -> DataFrame:
    return periods.monthly_periods(orders.accounting_periods(spark, d))


def _typed(spark: SparkSession, d: str) -> DataFrame:
    return timeline.order_types(orders.contract_lines(spark, d))


def _names(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return orders.transactions(spark, d), orders.items(spark, d), orders.customers(spark, d)


def _period_numbers(spark, d):
    return schedule.period_numbers(orders.contract_lines(spark, d))


def _expand_term(spark, d):
    expanded = schedule.expand_term(orders.contract_lines(spark, d))
    return expanded.withColumn("computed", F.col("computed").cast("decimal(38,15)"))


def _monthly_mrr(spark, d):
    return reports.monthly_mrr(
        orders.contract_lines(spark, d),
        orders.accounting_periods(spark, d),
        orders.transactions(spark, d),
    )


def _previous_end(spark, d):
    lines = orders.contract_lines(spark, d).select(*reports.PLACE)
    return timeline.previous_end(lines).drop("line_id")


def _previous_transaction(spark, d):
    transactions, items, customers = _names(spark, d)
    return reports.previous_transaction(
        orders.contract_lines(spark, d), customers, transactions, items
    )


def _new_renewal(spark, d):
    lines = orders.contract_lines(spark, d).select(*reports.PLACE)
    return timeline.tag_new_renewal(timeline.previous_end(lines)).drop("line_id")


def _gaps(spark, d):
    lines = orders.contract_lines(spark, d).select(*reports.PLACE)
    return timeline.with_gaps(lines).drop("line_id")


def _broken_renewals(spark, d):
    lines = orders.contract_lines(spark, d).select(*reports.PLACE)
    return timeline.broken_renewals(timeline.with_gaps(lines))


def _adjusted_order_type(spark, d):
    lines = orders.contract_lines(spark, d).select(*reports.PLACE)
    return timeline.order_types(lines).drop("line_id", "previousenddate")


def _churns(spark, d):
    return lifecycle.churns(_typed(spark, d))


def _churns_mrr(spark, d):
    return lifecycle.churns_mrr(_typed(spark, d), _months(spark, d))


def _lifecycle_union(spark, d):
    return lifecycle.lifecycle_union(_typed(spark, d))


def _lifecycle_union_mrr(spark, d):
    return lifecycle.lifecycle_union_mrr(_typed(spark, d), _months(spark, d))


def _lifecycle(spark, d):
    return reports.lifecycle(orders.contract_lines(spark, d), *_names(spark, d))


def _detail(**filters) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return reports.lifecycle_mrr(
            orders.contract_lines(spark, d),
            orders.accounting_periods(spark, d),
            *_names(spark, d),
            **filters,
        )

    return run


def _report_drilldown(spark, d):
    return reports.report_drilldown(
        orders.contract_lines(spark, d), orders.accounting_periods(spark, d)
    )


def _report_summary(spark, d, **filters):
    return reports.report_summary(
        orders.contract_lines(spark, d), orders.accounting_periods(spark, d), **filters
    )


def _report_summary_window(spark, d):
    return _report_summary(spark, d, between=SUMMARY_WINDOW)


def _resolved_import(spark, d):
    """Lines as an import file names them, with suppliers as items.

    Customers in debt are not known, so their lines are rejected.
    """
    lines = orders.contract_lines(spark, d)

    def named(prefix: str, number: str):
        return F.concat(F.lit(f"{prefix}#"), F.lpad(F.col(number).cast("string"), 9, "0"))

    typed = lines.select(
        "line_id",
        F.concat(F.lit("Order #"), F.col("tranid")).alias("transaction"),
        named("Customer", "customerid").alias("customer"),
        named("Supplier", "itemid").alias("item"),
        "contractid",
        "startdate",
        "enddate",
        "term",
        "amount",
        F.struct(named("Customer", "customerid").alias("customer")).alias("raw"),
        F.array().cast("array<string>").alias("problems"),
    )
    transactions = orders.transactions(spark, d).withColumnRenamed("trandisplayname", "name")
    known = orders.read(spark, d, "customer").where("c_acctbal >= 0")
    customers = known.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = orders.read(spark, d, "supplier")
    items = suppliers.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return contract_csv.resolve_references(typed, transactions, customers, items)


def _resolve_references(spark, d):
    return contract_csv.accepted(_resolved_import(spark, d))


def _rejected_references(spark, d):
    rows = contract_csv.rejected(_resolved_import(spark, d))
    return rows.select("line_id", "customer", F.array_join("problems", ", ").alias("problems"))


def _split_required(spark, d):
    """Lines that lack a mandatory field, with the names of what they lack."""
    _, lacking = checks.split_required(orders.hard_lines(spark, d), ["tranid", "startdate", "term"])
    return lacking.select("line_id", F.array_join("missing", ", ").alias("missing"))


def _duplicate_lines(spark, d):
    return checks.duplicate_lines(orders.hard_lines(spark, d))


def _null_dangling(spark, d):
    """Customers in debt and cheap parts count as deleted."""
    kept = orders.read(spark, d, "customer").where("c_acctbal >= 0")
    parts = orders.read(spark, d, "part").where("p_retailprice > 900")
    return checks.null_dangling(
        orders.contract_lines(spark, d),
        orders.transactions(spark, d),
        kept.select(F.col("c_custkey").alias("id")),
        parts.select(F.col("p_partkey").alias("id")),
    ).select("line_id", "tranid", "customerid", "itemid")


def _duplicate_tranids(spark, d):
    """Order lines taken as contract lines: many share their order."""
    lines = orders.read(spark, d, "lineitem")
    return checks.duplicate_tranids(lines.select(F.col("l_orderkey").alias("tranid")))


def _overlapping_periods(spark, d):
    """Quarters and years kept, so that they overlap the months."""
    every = orders.accounting_periods(spark, d).withColumnRenamed("id", "periodid")
    return periods.overlapping_periods(every)


def _hot(lines: DataFrame, way: str) -> DataFrame | str:
    """The timelines computed by pairs of dates: those too big for one task, all, or about half of them."""
    keys = lines.select(*timeline.KEY).distinct()
    half = F.coalesce("customerid", F.lit(0)) % 2 == 1
    return {"plain": "detect", "hot": keys, "mixed": keys.where(half)}[way]


def _hard(report: Callable, way: str = "plain") -> Callable[[SparkSession, str], DataFrame]:
    """A report over the lines with hard cases, by one of the ways to order timelines."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        lines = orders.hard_lines(spark, d)
        return report(spark, d, lines, _hot(lines, way))

    return run


def _hard_timeline(spark, d, lines, hot):
    return timeline.order_types(lines.drop("contractid"), hot=hot)


def _hard_lifecycle(spark, d, lines, hot):
    return lifecycle.lifecycle_union(timeline.order_types(lines.select(*reports.PLACE), hot=hot))


def _hard_drilldown(spark, d, lines, hot):
    return reports.report_drilldown(lines, orders.hard_periods(spark, d), hot=hot)


def _hard_summary(spark, d, lines, hot):
    return reports.report_summary(lines, orders.hard_periods(spark, d), hot=hot)


def _hard_monthly(**options) -> Callable:
    def report(spark, d, lines, hot):
        transactions = orders.transactions(spark, d)
        return reports.monthly_mrr(lines, orders.hard_periods(spark, d), transactions, **options)

    return report


def _whole_amounts(spark, d):
    """Lines with months, with their amount and the sum of their months."""
    lines = orders.hard_lines(spark, d).where("tranid is not null and term > 0").distinct()
    months = reports.monthly_mrr(lines, orders.accounting_periods(spark, d), orders.transactions(spark, d))
    sums = months.agg(F.sum("mrr").alias("total")).select(F.col("total").cast("decimal(38,2)"))
    return sums


def _stored_in_batches(spark, d, lines, months, batches: int = 4) -> TimelineStore:
    """The lines appended to a new store in several batches, each line id in one of them."""
    store = TimelineStore(spark, files.shared_folder(spark))
    for n in range(batches):
        batch = lines.where(F.pmod(F.xxhash64("line_id"), F.lit(batches)) == n)
        store.append(batch, months, f"batch-{n}")
    return store


def _maintained_timeline(spark, d):
    """Typed lines after appends that order only the timelines they touch."""
    store = _stored_in_batches(spark, d, orders.hard_lines(spark, d), orders.hard_periods(spark, d))
    return store.lines().drop("contractid", "firstday", "lastday", "bucket")


def _maintained_summary(spark, d):
    """The summary added up from what each append changes."""
    store = _stored_in_batches(spark, d, orders.hard_lines(spark, d), orders.hard_periods(spark, d))
    return store.summary(ordered=False)


def _maintained_window(spark, d):
    """A window of the summary, from the stored lines that post in it."""
    months = orders.accounting_periods(spark, d)
    store = _stored_in_batches(spark, d, orders.contract_lines(spark, d), months, 2)
    return store.summary_between(months, SUMMARY_WINDOW)


def _import_file(spark, d) -> str:
    """The lines as a folder of import files, with line breaks, quotes and commas in the customers' names."""
    folder = files.shared_folder(spark)
    lines = orders.contract_lines(spark, d)
    number = F.lpad(F.col("customerid").cast("string"), 9, "0")
    rows = lines.select(
        F.lit("7").alias(contract_csv.ID_HEADER),
        F.concat(F.lit("Order #"), F.col("tranid")).alias("Transaction"),
        F.concat(F.lit('The "first", or\nCustomer#'), number).alias("Customer"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("itemid").cast("string"), 9, "0")).alias("Item"),
        F.col("contractid").alias("Contract"),
        F.date_format("startdate", contract_csv.DATE_FORMAT).alias("Start Date"),
        F.date_format("enddate", contract_csv.DATE_FORMAT).alias("End Date"),
        F.col("term").alias("Term"),
        F.col("amount").alias("Total Amount"),
    )
    rows.write.options(header="true", quote='"', escape='"', quoteAll="true").csv(folder)
    return folder


def _imported(spark, d) -> tuple[str, str]:
    """A table and its rejected rows after the same files were imported twice; customers in debt are not known."""
    folder = _import_file(spark, d)
    lines, rejects = files.shared_folder(spark), files.shared_folder(spark)
    known = orders.read(spark, d, "customer").where("c_acctbal >= 0")
    lookups = (
        orders.transactions(spark, d).withColumnRenamed("trandisplayname", "name"),
        known.select(F.col("c_custkey").alias("id"), F.concat(F.lit('The "first", or\n'), "c_name").alias("name")),
        orders.read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
    )
    for _ in range(2):
        ledger.import_files(spark, folder, lines, rejects, *lookups, multiline="split")
    return lines, rejects


def _imported_lines(spark, d):
    lines, _ = _imported(spark, d)
    return tables.read_table(spark, lines, schemas.CONTRACT_LINES).drop("line_id")


def _imported_ids(spark, d):
    """Ids given to accepted and rejected rows: as many as there are rows, without gaps."""
    lines, rejects = _imported(spark, d)
    accepted = tables.read_table(spark, lines, schemas.CONTRACT_LINES).select("line_id")
    refused = spark.read.option("recursiveFileLookup", "true").parquet(rejects).select("line_id")
    given = accepted.unionByName(refused)
    return given.agg(
        F.min("line_id").alias("first_id"),
        F.max("line_id").alias("last_id"),
        F.countDistinct("line_id").alias("ids"),
        F.count("*").alias("rows"),
    )


def _deleted_references(spark, d):
    """Customers in debt and cheap parts are deleted from stored lines, file by file."""
    folder = files.shared_folder(spark)
    tables.append_lines(orders.contract_lines(spark, d), folder)
    debtors = orders.read(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    parts = orders.read(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_retailprice")
    missing = orders.contract_lines(spark, d).select(F.col("itemid").alias("id")).distinct()
    missing = missing.join(parts.where("p_retailprice > 900"), "id", "left_anti")
    tables.null_deleted(spark, folder, {"customerid": debtors, "itemid": missing})
    stored = tables.read_table(spark, folder, schemas.CONTRACT_LINES)
    return stored.select("line_id", "tranid", "customerid", "itemid")


def _replaced_report(spark, d):
    """The summary stored, then stored again over itself."""
    folder = files.shared_folder(spark)
    tables.save_report(_report_summary(spark, d), folder)
    tables.save_report(spark.read.parquet(folder), folder)
    return spark.read.parquet(folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query; those on documents only where their part is there."""
    more = dict(llm_queries.QUERIES) if llm_queries else {}
    if corpus_pipeline:
        more["pipeline"] = corpus_pipeline.run
    return own_queries() | more


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "monthly_periods": _months,
        "period_numbers": _period_numbers,
        "expand_term": _expand_term,
        "monthly_mrr": _monthly_mrr,
        "previous_end": _previous_end,
        "previous_transaction": _previous_transaction,
        "new_renewal": _new_renewal,
        "gaps": _gaps,
        "broken_renewals": _broken_renewals,
        "adjusted_order_type": _adjusted_order_type,
        "churns": _churns,
        "churns_mrr": _churns_mrr,
        "lifecycle_union": _lifecycle_union,
        "lifecycle_union_mrr": _lifecycle_union_mrr,
        "lifecycle": _lifecycle,
        "lifecycle_mrr": _detail(),
        "report_drilldown": _report_drilldown,
        "report_summary": _report_summary,
        "lifecycle_mrr_churn_period": _detail(churn_period=CHURN_PERIOD),
        "lifecycle_mrr_period": _detail(period=ORDER_PERIOD, ordertype="New"),
        "lifecycle_mrr_window": _detail(between=MONTH_WINDOW),
        "report_summary_window": _report_summary_window,
        "resolve_references": _resolve_references,
        "rejected_references": _rejected_references,
        "null_dangling": _null_dangling,
        "duplicate_tranids": _duplicate_tranids,
        "overlapping_periods": _overlapping_periods,
        "split_required": _split_required,
        "duplicate_lines": _duplicate_lines,
        "timeline_hard": _hard(_hard_timeline),
        "timeline_hot": _hard(_hard_timeline, "hot"),
        "timeline_mixed": _hard(_hard_timeline, "mixed"),
        "lifecycle_hard": _hard(_hard_lifecycle),
        "lifecycle_hot": _hard(_hard_lifecycle, "hot"),
        "report_drilldown_hard": _hard(_hard_drilldown),
        "report_summary_hard": _hard(_hard_summary),
        "report_summary_hot": _hard(_hard_summary, "hot"),
        "report_summary_mixed": _hard(_hard_summary, "mixed"),
        "monthly_mrr_hard": _hard(_hard_monthly()),
        "monthly_mrr_truncated": _hard(_hard_monthly(truncated=True)),
        "monthly_mrr_total": _whole_amounts,
        "maintained_timeline": _maintained_timeline,
        "maintained_summary": _maintained_summary,
        "maintained_window": _maintained_window,
        "imported_lines": _imported_lines,
        "imported_ids": _imported_ids,
        "deleted_references": _deleted_references,
        "replaced_report": _replaced_report,
    }


# Contract lines: term in hundredths of a month, amount and rate in cents.
_LINES = """
drawn AS (
  SELECT o_orderkey AS tranid, o_custkey AS customerid, o_orderkey % 3 AS itemid,
         CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE)
              ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS startdate,
         CASE o_orderkey % 5 WHEN 0 THEN 300 WHEN 1 THEN 600 WHEN 2 THEN 1200
                             WHEN 3 THEN 350 ELSE 50 END AS t,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents
  FROM orders),
lines AS (
  SELECT *, CAST(startdate + to_months(CAST(t // 100 AS INTEGER))
                 + to_days(CASE WHEN t % 100 = 0 THEN -1 ELSE 14 END) AS DATE) AS enddate,
         (200 * cents + t) // (2 * t) AS rate
  FROM drawn)"""

_PERIODS = """
years AS (
  SELECT CAST(date_trunc('year', min(startdate)) AS DATE) AS first_day,
         CAST(date_trunc('year', max(enddate + 1)) AS DATE) AS last_year
  FROM lines),
months AS (
  SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS periodid, strftime(d, '%b %Y') AS periodname,
         d AS startdate, last_day(d) AS enddate
  FROM (SELECT CAST(unnest(generate_series(first_day, last_year + INTERVAL 11 MONTH,
                                           INTERVAL 1 MONTH)) AS DATE) AS d FROM years))"""

_EXPANDED = """
longest AS (SELECT greatest(1, max(t) // 100) AS n FROM lines),
expanded AS (
  SELECT l.*, CAST(k AS INTEGER) AS period,
         CASE WHEN startdate = last_day(startdate)
              THEN last_day(startdate + to_months(CAST(k - 1 AS INTEGER)))
              ELSE CAST(startdate + to_months(CAST(k - 1 AS INTEGER)) AS DATE) END AS posting_day,
         CASE WHEN 100 * k > t THEN cents - t // 100 * rate
              WHEN 100 * k = t THEN cents - t // 100 * rate + rate
              ELSE rate END AS mrr_cents
  FROM (SELECT l.*, unnest(range(1, least((t + 99) // 100, n) + 1)) AS k
        FROM lines l, longest) l)"""

_PREVIOUS = """
ends AS (SELECT customerid, itemid, enddate, max(tranid) AS tranid FROM lines GROUP BY ALL),
previous AS (
  SELECT l.*, e.enddate AS previousenddate, e.tranid AS previoustranid
  FROM lines l ASOF LEFT JOIN ends e
    ON l.customerid = e.customerid AND l.itemid = e.itemid AND l.startdate > e.enddate)"""

_TYPED = """
gaps AS (
  SELECT *, CAST(startdate - lag(enddate) OVER timeline AS INTEGER) AS gapwithprevious,
         CAST(lead(startdate) OVER timeline - enddate AS INTEGER) AS gapwithnext
  FROM previous
  WINDOW timeline AS (PARTITION BY customerid, itemid ORDER BY enddate, startdate, tranid)),
typed AS (
  SELECT *, CASE WHEN previousenddate IS NULL OR gapwithprevious > 1
                 THEN 'New' ELSE 'Renewal' END AS ordertype
  FROM gaps),
churned AS (
  SELECT *, CAST(enddate + 1 AS DATE) AS churn_day
  FROM typed WHERE gapwithnext > 1 OR gapwithnext IS NULL)"""

# One row per contract month and per churn.
_POSTED = """
posted AS (
  SELECT x.tranid, x.customerid, x.itemid, ty.ordertype, ty.previoustranid,
         x.posting_day, x.mrr_cents
  FROM expanded x JOIN typed ty USING (tranid)
  UNION ALL
  SELECT NULL, customerid, itemid, 'Churn', tranid, churn_day, rate FROM churned),
dated AS (
  SELECT p.*, m.periodid, m.periodname, m.startdate AS period_start
  FROM posted p LEFT JOIN months m ON p.posting_day BETWEEN m.startdate AND m.enddate)"""

_CUSTOMERS = """
people AS (
  SELECT c_custkey AS id, c_custkey % 4 <> 0 AS company, c_name AS companyname,
         CASE WHEN c_custkey % 4 = 0 AND c_custkey % 8 <> 0
              THEN split_part(c_name, '#', 1) ELSE '' END || ' ' ||
         CASE WHEN c_custkey % 4 = 0 THEN split_part(c_name, '#', 2) ELSE '' END AS person
  FROM customer)"""


# The lines of ``orders.hard_lines``; t and cents as above, missing where the line lacks them.
_HARD_LINES = """
drawn AS (
  SELECT o_orderkey AS k, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents,
         CASE WHEN o_orderkey % 6 = 0 THEN last_day(CAST(o_orderdate AS DATE))
              WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE)
              ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS begins,
         CASE o_orderkey % 5 WHEN 0 THEN 300 WHEN 1 THEN 600 WHEN 2 THEN 1200
                             WHEN 3 THEN 350 ELSE 50 END AS usual
  FROM orders, (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR o_orderkey % 10 = 1),
keyed AS (
  SELECT k AS line_id, cents,
         CASE WHEN k % 11 = 0 THEN NULL WHEN k % 26 = 3 THEN k - 1 ELSE k END AS tranid,
         CASE WHEN k % 13 = 0 THEN NULL WHEN k % 3 = 0 THEN 1 ELSE o_custkey END AS customerid,
         CASE WHEN k % 17 = 0 THEN NULL WHEN k % 3 = 0 THEN 1 ELSE k % 7 END AS itemid,
         CASE WHEN k % 19 <> 0 THEN begins END AS startdate,
         CASE WHEN k % 23 <> 0 THEN
           CAST(begins + to_months(CAST(usual // 100 AS INTEGER))
                + to_days(CASE WHEN usual % 100 = 0 THEN -1 ELSE 14 END) AS DATE) END AS enddate,
         CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN 0 WHEN k % 37 = 0 THEN -100
              WHEN k % 41 = 0 THEN 1450 ELSE usual END AS t
  FROM drawn),
lines AS (
  SELECT *, CASE WHEN tranid IS NOT NULL AND t <> 0
                 THEN sign(t) * ((200 * cents + abs(t)) // (2 * abs(t))) END AS rate
  FROM keyed)"""

_HARD_PERIODS = """
usual_lines AS (SELECT * FROM ({usual})),
usual_years AS (
  SELECT CAST(date_trunc('year', min(startdate)) AS DATE) AS first_day,
         CAST(date_trunc('year', max(enddate + 1)) AS DATE) AS last_year
  FROM usual_lines),
months AS (
  SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS periodid, strftime(d, '%b %Y') AS periodname,
         d AS startdate, last_day(d) AS enddate
  FROM (SELECT CAST(unnest(generate_series(first_day, last_year + INTERVAL 11 MONTH,
                                           INTERVAL 1 MONTH)) AS DATE) AS d FROM usual_years)
  UNION ALL SELECT 99, 'Stub', DATE '1997-03-10', DATE '1997-04-20')""".format(
    usual="WITH" + _LINES + " SELECT startdate, enddate FROM lines"
)

_HARD_TYPED = """
gaps AS (
  SELECT *, CAST(startdate - lag(enddate) OVER timeline AS INTEGER) AS gapwithprevious,
         CAST(lead(startdate) OVER timeline - enddate AS INTEGER) AS gapwithnext
  FROM previous
  WINDOW timeline AS (PARTITION BY customerid, itemid
                      ORDER BY enddate NULLS LAST, startdate NULLS LAST, tranid NULLS LAST, line_id)),
typed AS (
  SELECT *, CASE WHEN previousenddate IS NULL OR (gapwithprevious > 1 AND enddate IS NOT NULL)
                 THEN 'New' ELSE 'Renewal' END AS ordertype
  FROM gaps),
churned AS (
  SELECT *, CAST(enddate + 1 AS DATE) AS churn_day
  FROM typed WHERE gapwithnext > 1 OR gapwithnext IS NULL)"""


def _hard_expanded(source: str, truncated: bool = False) -> str:
    """Contract months of every line of ``source``, and one row for a line without months."""
    last = "least((t + 99) // 100, greatest(1, (SELECT max(t) // 100 FROM lines)))" if truncated else "(t + 99) // 100"
    return f"""
expanded AS (
  SELECT l.*, CASE WHEN startdate = last_day(startdate)
                   THEN last_day(startdate + to_months(CAST(k - 1 AS INTEGER)))
                   ELSE CAST(startdate + to_months(CAST(k - 1 AS INTEGER)) AS DATE) END AS posting_day,
         CASE WHEN 100 * k > t THEN cents - t // 100 * rate
              WHEN 100 * k = t THEN cents - t // 100 * rate + rate
              ELSE rate END AS mrr_cents
  FROM (SELECT l.*, unnest(range(1, {last} + 1)) AS k FROM {source} l
        WHERE tranid IS NOT NULL AND t > 0) l
  UNION ALL
  SELECT *, NULL, NULL FROM (SELECT *, NULL AS k FROM {source}) WHERE tranid IS NULL OR t IS NULL OR t <= 0)"""


_HARD_POSTED = """
posted AS (
  SELECT tranid, customerid, itemid, ordertype, previoustranid, posting_day, mrr_cents FROM expanded
  UNION ALL
  SELECT NULL, customerid, itemid, 'Churn', tranid, churn_day, rate FROM churned),
dated AS (
  SELECT p.*, m.periodid, m.periodname, m.startdate AS period_start
  FROM posted p LEFT JOIN months m ON p.posting_day BETWEEN m.startdate AND m.enddate)"""


def _with(*parts: str) -> str:
    return "WITH" + ",".join(parts) + "\n"


def _money(cents: str) -> str:
    """Cents as exact money: a product of decimals stays decimal."""
    return f"CAST(CAST({cents} AS DECIMAL(17,0)) * 0.01 AS DECIMAL(18,2))"


_TERM = "CAST(CAST(t AS DECIMAL(6,0)) * 0.01 AS DECIMAL(12,6))"


def _detail_sql(condition: str = "TRUE", dated: str = "dated") -> str:
    return f"""
SELECT d.tranid, 'Order #' || d.tranid AS "transaction",
       CASE WHEN c.company THEN c.companyname ELSE c.person END AS customer,
       'Part ' || p.p_partkey AS item, d.ordertype, d.previoustranid, d.periodname AS postingperiod,
       {_money("d.mrr_cents")} AS mrr
FROM {dated} d LEFT JOIN people c ON c.id = d.customerid LEFT JOIN part p ON p.p_partkey = d.itemid
WHERE {condition}"""


def oracle_sql() -> dict[str, str]:
    more = dict(llm_queries.ORACLE_SQL) if llm_queries else {}
    return own_sql() | more


def own_sql() -> dict[str, str]:
    typed = (_LINES, _PREVIOUS, _TYPED)
    posted = (_LINES, _PERIODS, _EXPANDED, _PREVIOUS, _TYPED, _POSTED)
    place = "tranid, customerid, itemid, startdate, enddate"
    summary = f"""
SELECT periodname AS period, ordertype,
       CAST(CAST(sum(mrr_cents) AS DECIMAL(36,0)) * 0.01 AS DECIMAL(38,2)) AS mrr
FROM dated WHERE periodid IS NOT NULL {{window}}
GROUP BY periodid, periodname, ordertype"""
    low, high = MONTH_WINDOW
    # Contracts without a month in the window keep one row without period and amount.
    window = f"""
shown AS (
  SELECT * FROM dated
  WHERE ordertype = 'Churn' OR posting_day BETWEEN DATE '{low}' AND DATE '{high}'
  UNION ALL
  SELECT tranid, customerid, itemid, ordertype, previoustranid, NULL, NULL, NULL, NULL, NULL
  FROM typed WHERE tranid NOT IN (
    SELECT tranid FROM expanded WHERE posting_day BETWEEN DATE '{low}' AND DATE '{high}'))"""
    hard = (_HARD_LINES, _PREVIOUS, _HARD_TYPED)
    hard_posted = (*hard, _HARD_PERIODS, _hard_expanded("typed"), _HARD_POSTED)
    hard_timeline = _with(*hard) + f"""SELECT line_id, {place}, {_TERM} AS term, {_money("cents")} AS amount,
       previousenddate, previoustranid, gapwithprevious, gapwithnext, ordertype FROM typed"""
    hard_lifecycle = _with(*hard) + f"""SELECT {place}, ordertype, previoustranid FROM typed
UNION ALL
SELECT NULL, customerid, itemid, churn_day, churn_day, 'Churn', NULL FROM churned"""
    hard_summary = _with(*hard_posted) + summary.format(window="")
    hard_monthly = f"""SELECT '#' || o.o_orderkey AS "transaction", {_TERM} AS term, {_money("cents")} AS amount,
       m.startdate, m.periodid AS postingperiodid, m.periodname AS postingperiod, {_money("mrr_cents")} AS mrr
FROM expanded x LEFT JOIN orders o ON o.o_orderkey = x.tranid
LEFT JOIN months m ON x.posting_day BETWEEN m.startdate AND m.enddate"""
    return {
        "split_required": _with(_HARD_LINES)
        + """SELECT line_id, concat_ws(', ', CASE WHEN tranid IS NULL THEN 'tranid' END,
       CASE WHEN startdate IS NULL THEN 'startdate' END, CASE WHEN t IS NULL THEN 'term' END) AS missing
FROM lines WHERE tranid IS NULL OR startdate IS NULL OR t IS NULL""",
        "duplicate_lines": _with(_HARD_LINES)
        + "SELECT line_id, count(*) AS lines FROM lines GROUP BY line_id HAVING count(*) > 1",
        "timeline_hard": hard_timeline,
        "timeline_hot": hard_timeline,
        "timeline_mixed": hard_timeline,
        "lifecycle_hard": hard_lifecycle,
        "lifecycle_hot": hard_lifecycle,
        "report_drilldown_hard": _with(*hard_posted)
        + f"""SELECT ordertype, periodid AS postingperiodid, periodname AS postingperiod,
       {_money("mrr_cents")} AS mrr FROM dated""",
        "report_summary_hard": hard_summary,
        "report_summary_hot": hard_summary,
        "report_summary_mixed": hard_summary,
        "monthly_mrr_hard": _with(_HARD_LINES, _HARD_PERIODS, _hard_expanded("lines")) + hard_monthly,
        "monthly_mrr_truncated": _with(_HARD_LINES, _HARD_PERIODS, _hard_expanded("lines", True)) + hard_monthly,
        "monthly_mrr_total": _with(_HARD_LINES)
        + """SELECT CAST(CAST(sum(cents) AS DECIMAL(36,0)) * 0.01 AS DECIMAL(38,2)) AS total
FROM (SELECT DISTINCT line_id, cents FROM lines WHERE tranid IS NOT NULL AND t > 0)""",
        "monthly_periods": _with(_LINES, _PERIODS) + "SELECT * FROM months",
        "period_numbers": _with(_LINES, _EXPANDED)
        + "SELECT CAST(unnest(range(1, n + 1)) AS INTEGER) AS period FROM longest",
        "expand_term": _with(_LINES, _EXPANDED)
        + f"""SELECT tranid AS id, customerid, itemid, {_TERM} AS term, {_money("cents")} AS amount,
       period, CAST(CAST((2 * CAST(cents AS HUGEINT) * 1000000000000000 + t) // (2 * t) AS DECIMAL(22,0))
                    * CAST(0.000000000000001 AS DECIMAL(16,15)) AS DECIMAL(38,15)) AS computed,
       CASE WHEN t % 100 = 0 THEN 'No' ELSE 'Yes' END AS ispartialterm
FROM expanded""",
        "monthly_mrr": _with(_LINES, _PERIODS, _EXPANDED)
        + f"""SELECT '#' || x.tranid AS "transaction", {_TERM} AS term,
       {_money("cents")} AS amount, m.startdate, m.periodid AS postingperiodid,
       m.periodname AS postingperiod, {_money("mrr_cents")} AS mrr
FROM expanded x LEFT JOIN months m ON x.posting_day BETWEEN m.startdate AND m.enddate""",
        "previous_end": _with(_LINES, _PREVIOUS)
        + f"SELECT {place}, previousenddate, previoustranid FROM previous",
        "previous_transaction": _with(_LINES, _PREVIOUS, _CUSTOMERS)
        + """SELECT v.tranid AS transactionid, '#' || v.tranid AS "transaction",
       c.person AS customer, 'Part ' || p.p_partkey AS item, v.startdate, v.enddate,
       v.previousenddate, v.previoustranid
FROM previous v JOIN people c ON c.id = v.customerid LEFT JOIN part p ON p.p_partkey = v.itemid""",
        "new_renewal": _with(_LINES, _PREVIOUS)
        + f"""SELECT {place}, previousenddate, previoustranid,
       CASE WHEN previousenddate IS NULL THEN 'New' ELSE 'Renewal' END AS ordertype
FROM previous""",
        "gaps": _with(*typed) + f"SELECT {place}, gapwithprevious, gapwithnext FROM gaps",
        "broken_renewals": _with(*typed)
        + f"""SELECT {place}, 'New' AS adjustedordertype, gapwithprevious, gapwithnext
FROM gaps WHERE gapwithprevious >= 2""",
        "adjusted_order_type": _with(*typed)
        + f"SELECT {place}, gapwithprevious, gapwithnext, previoustranid, ordertype FROM typed",
        "churns": _with(*typed)
        + """SELECT customerid, itemid, churn_day AS startdate, churn_day AS enddate,
       'Churn' AS ordertype FROM churned""",
        "churns_mrr": _with(*typed, _PERIODS)
        + f"""SELECT c.tranid AS previoustranid, customerid, itemid, churn_day AS startdate,
       churn_day AS enddate, 'Churn' AS ordertype, m.periodname AS postingperiod,
       m.periodid AS postingperiodid, {_money("rate")} AS computed
FROM churned c LEFT JOIN months m ON churn_day BETWEEN m.startdate AND m.enddate""",
        "lifecycle_union": _with(*typed)
        + f"""SELECT {place}, ordertype, previoustranid FROM typed
UNION ALL
SELECT NULL, customerid, itemid, churn_day, churn_day, 'Churn', NULL FROM churned""",
        "lifecycle_union_mrr": _with(*typed, _PERIODS)
        + f"""SELECT {place}, ordertype, previoustranid, CAST(NULL AS VARCHAR) AS postingperiod,
       CAST(NULL AS INTEGER) AS postingperiodid, CAST(0 AS DECIMAL(18,2)) AS computed FROM typed
UNION ALL
SELECT NULL, customerid, itemid, churn_day, churn_day, 'Churn', tranid, m.periodname, m.periodid,
       {_money("rate")}
FROM churned c LEFT JOIN months m ON churn_day BETWEEN m.startdate AND m.enddate""",
        "lifecycle": _with(*typed, _CUSTOMERS)
        + """SELECT u.tranid AS transactionid, 'Order #' || u.tranid AS "transaction",
       c.person AS customer, p.p_name AS item, u.startdate, u.enddate, u.ordertype,
       u.previoustranid
FROM (SELECT tranid, customerid, itemid, startdate, enddate, ordertype, previoustranid FROM typed
      UNION ALL
      SELECT NULL, customerid, itemid, churn_day, churn_day, 'Churn', NULL FROM churned) u
LEFT JOIN people c ON c.id = u.customerid LEFT JOIN part p ON p.p_partkey = u.itemid""",
        "lifecycle_mrr": _with(*posted, _CUSTOMERS) + _detail_sql(),
        "report_drilldown": _with(*posted)
        + f"""SELECT ordertype, periodid AS postingperiodid, periodname AS postingperiod,
       {_money("mrr_cents")} AS mrr FROM dated""",
        "report_summary": _with(*posted) + summary.format(window=""),
        "lifecycle_mrr_churn_period": _with(*posted, _CUSTOMERS)
        + _detail_sql(f"d.ordertype = 'Churn' AND d.periodid = {CHURN_PERIOD}"),
        "lifecycle_mrr_period": _with(*posted, _CUSTOMERS)
        + _detail_sql(f"d.ordertype = 'New' AND d.periodid = {ORDER_PERIOD}"),
        "lifecycle_mrr_window": _with(*posted, _CUSTOMERS, window) + _detail_sql(dated="shown"),
        "report_summary_window": _with(*posted)
        + summary.format(
            window="AND period_start BETWEEN DATE '{}' AND DATE '{}'".format(*SUMMARY_WINDOW)
        ),
        "maintained_timeline": hard_timeline,
        "maintained_summary": hard_summary,
        "maintained_window": _with(*posted)
        + summary.format(
            window="AND period_start BETWEEN DATE '{}' AND DATE '{}'".format(*SUMMARY_WINDOW)
        ),
        "replaced_report": _with(*posted) + summary.format(window=""),
        "imported_lines": _with(_LINES)
        + f"""SELECT tranid, customerid, s_suppkey AS itemid, CAST(tranid AS VARCHAR) AS contractid, startdate, enddate,
       {_TERM} AS term, {_money("cents")} AS amount
FROM lines JOIN customer ON c_custkey = customerid AND c_acctbal >= 0 JOIN supplier ON s_suppkey = itemid""",
        "imported_ids": _with(_LINES)
        + """SELECT CAST(1 AS BIGINT) AS first_id, count(*) AS last_id, count(*) AS ids, count(*) AS rows FROM lines""",
        "deleted_references": _with(_LINES)
        + """SELECT tranid AS line_id, tranid, c_custkey AS customerid, p_partkey AS itemid
FROM lines LEFT JOIN customer ON c_custkey = customerid AND c_acctbal >= 0
LEFT JOIN part ON p_partkey = itemid AND p_retailprice > 900""",
        "resolve_references": _with(_LINES)
        + f"""SELECT tranid AS line_id, tranid, customerid, itemid,
       CAST(tranid AS VARCHAR) AS contractid, startdate, enddate, {_TERM} AS term,
       {_money("cents")} AS amount
FROM lines JOIN customer ON c_custkey = customerid AND c_acctbal >= 0""",
        "rejected_references": _with(_LINES)
        + """SELECT tranid AS line_id, 'Customer#' || lpad(CAST(customerid AS VARCHAR), 9, '0') AS customer,
       'unknown customer' AS problems
FROM lines JOIN customer ON c_custkey = customerid AND c_acctbal < 0""",
        "null_dangling": _with(_LINES)
        + """SELECT tranid AS line_id, tranid, c_custkey AS customerid, p_partkey AS itemid
FROM lines LEFT JOIN customer ON c_custkey = customerid AND c_acctbal >= 0
LEFT JOIN part ON p_partkey = itemid AND p_retailprice > 900""",
        "duplicate_tranids": """SELECT l_orderkey AS tranid, count(*) AS lines
FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""",
        "overlapping_periods": _with(_LINES, _PERIODS)
        + """, every AS (
  SELECT * FROM months
  UNION ALL
  SELECT CAST(year(startdate) * 10 + quarter(startdate) AS INTEGER),
         'Q' || quarter(startdate) || ' ' || year(startdate), startdate,
         last_day(CAST(startdate + INTERVAL 2 MONTH AS DATE))
  FROM months WHERE month(startdate) IN (1, 4, 7, 10)
  UNION ALL
  SELECT CAST(year(startdate) AS INTEGER), 'FY ' || year(startdate), startdate,
         last_day(CAST(startdate + INTERVAL 11 MONTH AS DATE))
  FROM months WHERE month(startdate) = 1)
SELECT periodid, periodname, startdate, enddate FROM every e
WHERE EXISTS (
  SELECT 1 FROM every o
  WHERE (o.startdate < e.startdate OR o.startdate = e.startdate AND o.periodid < e.periodid)
    AND o.enddate >= e.startdate)""",
    }
