"""Reports over contract lines and their lookup tables.

Every report takes plain DataFrames and returns one. The lookups carry no
broadcast hint: Catalyst broadcasts a lookup table while its size is below
autoBroadcastJoinThreshold, and AQE splits skewed keys of a shuffled join.
Names are looked up per line, before lines are spread over months, unless the
report keeps one period: then only what is left of them looks names up.

``ordered=False`` leaves out the final sort, for results written to a table.
``truncated=True`` drops the partial last month of lines longer than the longest
term rounded down, as the literal definition does; see ``month_count``.
``options`` (``hot``, ``clustered``) go to the timeline operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewline.functions.dates import add_months_keep_end
from renewline.functions.money import month_amount, shown
from renewline.functions.text import customer_name, person_name
from renewline.operators.lifecycle import churn_day, has_churn, lifecycle_columns, with_churn_rows
from renewline.operators.periods import monthly_periods, posting_period
from renewline.operators.schedule import (
    month_count,
    month_list,
    with_amounts,
    with_month_bounds,
)
from renewline.operators.timeline import order_types, previous_end

Days = tuple[str, str]

PLACE = ["line_id", "tranid", "customerid", "itemid", "startdate", "enddate"]
VALUE = ["term", "amount"]

# Months that one task sorts, on average.
MONTHS_AT_ONCE = 500_000


def _sorted(df: DataFrame, by: list[str], ordered: bool) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in by]) if ordered else df


def _with_name(lines: DataFrame, key: str, names: DataFrame, name: Column, how: str = "left") -> DataFrame:
    """Add ``name`` from the row of ``names`` whose id is ``key``."""
    chosen = names.select(F.col("id").alias(f"{key}_of_name"), name)
    return lines.join(chosen, F.col(key) == F.col(f"{key}_of_name"), how)


def _transaction_name() -> Column:
    return F.col("trandisplayname").alias("transaction")


def _item_name() -> Column:
    return F.col("displayname").alias("item")


def _item_display() -> Column:
    """How a reference to the item is shown."""
    return F.col("display").alias("item")


def _transaction_display() -> Column:
    """How a reference to the transaction is shown."""
    return F.col("display").alias("transaction")


def _person_name() -> Column:
    return person_name(F.col("firstname"), F.col("lastname")).alias("customer")


def _customer_name() -> Column:
    name = customer_name(
        F.col("isperson"), F.col("companyname"), F.col("firstname"), F.col("lastname")
    )
    return name.alias("customer")


def _days(months: DataFrame) -> tuple[Column, Column]:
    """First and last day of the given months, as scalar subqueries."""
    return months.agg(F.min("startdate")).scalar(), months.agg(F.max("enddate")).scalar()


def _postable_months(lines: DataFrame, truncated: bool) -> Column:
    """Months a line posts; none without a transaction, which matches nothing."""
    return F.when(F.col("tranid").isNotNull(), month_count(lines, truncated))


def _posting_day() -> Column:
    """Date of contract month ``period``, counted from 1; 0 stands for the churn."""
    return F.when(F.col("period") == 0, churn_day()).otherwise(
        add_months_keep_end(F.col("startdate"), F.col("period") - 1)
    )


def _posting_amount() -> Column:
    return F.when(F.col("period") == 0, F.col("rate")).otherwise(
        month_amount(F.col("period"), F.col("term"), F.col("rate"), F.col("closing"))
    )


def _sort_tasks(lines: DataFrame) -> int:
    """Tasks to sort the months of all lines in. Runs one small counting job.

    AQE would merge partitions by the size of the lines, before they are spread
    over months, so it is the months that are counted.
    """
    rows = F.greatest(F.lit(1), F.coalesce(month_count(lines), F.lit(1))).cast("long")
    months = lines.agg(F.sum(rows)).first()[0] or 0
    return max(lines.sparkSession.sparkContext.defaultParallelism, -(-months // MONTHS_AT_ONCE))


def monthly_mrr(
    lines: DataFrame,
    periods: DataFrame,
    transaction: DataFrame,
    truncated: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Monthly revenue of every contract month, with the period it posts to.

    A line without months, or a month without a period, stays with NULLs.
    """
    named = _with_name(
        lines.select("line_id", "tranid", "startdate", *VALUE),
        "tranid",
        transaction,
        _transaction_display(),
    )
    counted = with_month_bounds(named, _postable_months(lines, truncated))
    expands = F.coalesce(F.col("last_month") >= 1, F.lit(False))
    keyed = counted.select(
        "*",
        F.when(expands, F.col("tranid")).alias("sort_id"),
        F.when(~expands, F.col("line_id")).alias("sort_line"),
    )
    if ordered:
        # Ranges of lines are ranges of their months too, so the lines are
        # exchanged and the final sort needs no exchange of all the months.
        keyed = keyed.repartitionByRange(
            _sort_tasks(lines), F.asc_nulls_last("sort_id"), F.asc_nulls_last("sort_line")
        )
    spread = with_amounts(keyed).withColumn("period", F.explode_outer(month_list()))
    day = add_months_keep_end(F.col("startdate"), F.col("period") - 1)
    mrr = month_amount(F.col("period"), F.col("term"), F.col("rate"), F.col("closing"))
    posted = posting_period(spread, day, monthly_periods(periods))
    return _sorted(posted, ["sort_id", "sort_line", "period"], ordered).select(
        "transaction",
        "term",
        "amount",
        F.col("periodstart").alias("startdate"),
        "postingperiodid",
        "postingperiod",
        shown(mrr).alias("mrr"),
    )


def previous_transaction(
    lines: DataFrame,
    customer: DataFrame,
    transaction: DataFrame,
    item: DataFrame,
    ordered: bool = True,
    **options,
) -> DataFrame:
    """The contract each line follows; lines of unknown customers are left out."""
    found = previous_end(lines.select(*PLACE), **options)
    named = _with_name(found, "customerid", customer, _person_name(), "inner")
    named = _with_name(named, "itemid", item, _item_display())
    named = _with_name(named, "tranid", transaction, _transaction_display())
    return _sorted(named, ["tranid", "line_id"], ordered).select(
        F.col("tranid").alias("transactionid"),
        "transaction",
        "customer",
        "item",
        "startdate",
        "enddate",
        "previousenddate",
        "previoustranid",
    )


def lifecycle(
    lines: DataFrame,
    transaction: DataFrame,
    item: DataFrame,
    customer: DataFrame,
    ordered: bool = True,
    **options,
) -> DataFrame:
    """New, Renewal and Churn rows with names."""
    typed = order_types(lines.select(*PLACE), **options)
    named = _with_name(typed, "tranid", transaction, _transaction_name())
    named = _with_name(named, "itemid", item, _item_name())
    named = _with_name(named, "customerid", customer, _person_name())
    rows = with_churn_rows(named).select(
        *lifecycle_columns(F.lit(None).cast("long")),
        F.when(~F.col("churned"), F.col("transaction")).alias("transaction"),
        "customer",
        "item",
        "line_id",
    )
    by = ["customerid", "itemid", "startdate", "enddate", "ordertype", "tranid", "line_id"]
    return _sorted(rows, by, ordered).select(
        F.col("tranid").alias("transactionid"),
        "transaction",
        "customer",
        "item",
        "startdate",
        "enddate",
        "ordertype",
        "previoustranid",
    )


def _posted_rows(
    typed: DataFrame,
    lines: DataFrame,
    months: DataFrame,
    truncated: bool,
    between: Days | None,
    contracts: bool,
    churned: bool,
) -> DataFrame:
    """One row per contract month and per churn, with period and amount.

    A contract without months stays as one row without period and amount. One
    array of month numbers per line, 0 for its churn, makes all rows in one
    pass, and one lookup finds the period of both kinds.
    """
    own = F.coalesce(month_list(), F.array(F.lit(None).cast("int")))
    rows = with_month_bounds(with_amounts(typed), _postable_months(lines, truncated), between)
    if not contracts:
        rows = rows.where(has_churn()).withColumn("period", F.lit(0))
    elif not churned:
        rows = rows.withColumn("period", F.explode(own))
    else:
        with_churn = F.when(has_churn(), F.concat(F.array(F.lit(0)), own)).otherwise(own)
        rows = rows.withColumn("period", F.explode(with_churn))
    rows = rows.withColumn("churned", F.coalesce(F.col("period") == 0, F.lit(False)))
    return posting_period(rows, _posting_day(), months).withColumn(
        "mrr", shown(_posting_amount())
    )


def lifecycle_mrr(
    lines: DataFrame,
    periods: DataFrame,
    transaction: DataFrame,
    item: DataFrame,
    customer: DataFrame,
    churn_period: int | None = None,
    period: int | None = None,
    ordertype: str | None = None,
    between: Days | None = None,
    truncated: bool = False,
    ordered: bool = True,
    **options,
) -> DataFrame:
    """Order type and revenue of every contract month, and every churn.

    ``churn_period`` keeps the churns of one period, ``period`` the contract
    months of one, ``ordertype`` the rows of one type; ``between`` keeps the
    contract months dated in a window.
    """
    if churn_period is not None and (period is not None or ordertype not in (None, "Churn")):
        raise ValueError("ask for the churns or for the contract months of a period, not both")
    contracts = churn_period is None and (ordertype != "Churn" or period is not None)
    churned = period is None and ordertype in (None, "Churn")
    typed = order_types(lines.select(*PLACE, *VALUE), **options)
    if contracts and ordertype is not None:
        typed = typed.where(F.col("ordertype") == ordertype)

    def with_names(rows: DataFrame) -> DataFrame:
        named = _with_name(rows, "tranid", transaction, _transaction_name())
        named = _with_name(named, "itemid", item, _item_display())
        return _with_name(named, "customerid", customer, _customer_name())

    months = monthly_periods(periods)
    wanted = churn_period if churn_period is not None else period
    if wanted is None:
        rows = _posted_rows(with_names(typed), lines, months, truncated, between, contracts, churned)
    else:
        months = months.where(F.col("periodid") == wanted)
        if between is None:
            # The days of the wanted period bound the months that are made.
            between = _days(months)
        rows = _posted_rows(typed, lines, months, truncated, between, contracts, churned)
        rows = with_names(rows.where(F.col("postingperiodid").isNotNull()))
    rows = rows.select(
        *lifecycle_columns(F.col("tranid")),
        F.when(~F.col("churned"), F.col("transaction")).alias("transaction"),
        "customer",
        "item",
        "postingperiod",
        "mrr",
        F.when(~F.col("churned"), F.col("period")).alias("period"),
        "line_id",
    )
    by = ["itemid", "startdate", "period", "customerid", "ordertype", "line_id"]
    return _sorted(rows, by, ordered).select(
        "tranid",
        "transaction",
        "customer",
        "item",
        "ordertype",
        "previoustranid",
        "postingperiod",
        "mrr",
    )


def report_drilldown(
    lines: DataFrame,
    periods: DataFrame,
    between: Days | None = None,
    truncated: bool = False,
    **options,
) -> DataFrame:
    """Order type, period and revenue of every contract month and churn."""
    typed = order_types(lines.select(*PLACE, *VALUE), **options)
    rows = _posted_rows(typed, lines, monthly_periods(periods), truncated, between, True, True)
    return rows.select(
        F.when(F.col("churned"), "Churn").otherwise(F.col("ordertype")).alias("ordertype"),
        "postingperiodid",
        "postingperiod",
        "mrr",
    )


def report_summary(
    lines: DataFrame,
    periods: DataFrame,
    between: Days | None = None,
    months_between: Days | None = None,
    truncated: bool = False,
    ordered: bool = True,
    **options,
) -> DataFrame:
    """Revenue by period and order type.

    ``between`` keeps the periods that start in a window, ``months_between``
    the contract months dated in one.
    """
    typed = order_types(lines.select(*PLACE, *VALUE), **options)
    count = month_count(lines, truncated)
    return summarise(typed, periods, between, months_between, ordered, count)


def summarise(
    typed: DataFrame,
    periods: DataFrame,
    between: Days | None = None,
    months_between: Days | None = None,
    ordered: bool = True,
    count: Column | None = None,
) -> DataFrame:
    """``report_summary`` of lines whose order types and gaps are known, as those of a store are."""
    months = months_starting(periods, between)
    posted = _posted_sums(_summed(typed, []), months, month_count(typed) if count is None else count, months_between)
    summary = posted.groupBy(*SUMMARY_KEY).agg(F.sum(_posting_amount()).alias("mrr"))
    return _sorted(summary, ["periodstart", "ordertype", "postingperiodid"], ordered).select(
        F.col("postingperiod").alias("period"), "ordertype", "mrr"
    )


SUMMARY_KEY = ["postingperiodid", "postingperiod", "periodstart", "ordertype"]


def months_starting(periods: DataFrame, between: Days | None) -> DataFrame:
    """Month periods, of a window of starts if given."""
    months = monthly_periods(periods)
    if between is None:
        return months
    low, high = (F.to_date(F.lit(day)) for day in between)
    return months.where(F.col("startdate").between(low, high))


def _summed(typed: DataFrame, more: list[Column], sign: Column | None = None) -> DataFrame:
    """Monthly amounts of all lines that post to the same periods.

    Lines of one order type that start on one day with one term post to the
    same periods, so their monthly amounts are added up first, on the map side
    of the exchange, and only the sums are spread over months. ``sign`` tells
    lines to take away from lines to add.
    """
    rows = with_churn_rows(with_amounts(typed))
    churned = F.col("churned")

    def signed(amount: Column) -> Column:
        return amount if sign is None else F.when(sign < 0, -amount).otherwise(amount)

    return (
        rows.where(churned | (F.col("tranid").isNotNull() & (F.col("term") > 0)))
        .groupBy(
            "churned",
            F.when(churned, "Churn").otherwise(F.col("ordertype")).alias("ordertype"),
            F.when(~churned, F.col("startdate")).alias("startdate"),
            F.when(churned, F.col("enddate")).alias("enddate"),
            F.when(~churned, F.col("term")).alias("term"),
        )
        .agg(
            F.sum(signed(F.col("rate"))).alias("rate"),
            F.sum(signed(F.when(~churned, F.col("closing")))).alias("closing"),
            *more,
        )
    )


def _posted_sums(
    sums: DataFrame, months: DataFrame, count: Column, months_between: Days | None = None
) -> DataFrame:
    numbers = F.when(F.col("churned"), F.array(F.lit(0))).otherwise(month_list())
    spread = with_month_bounds(sums, count, months_between).withColumn("period", F.explode(numbers))
    return posting_period(spread, _posting_day(), months, "inner")


# Summary kept up to date -----------------------------------------------------


def summary_changes(before: DataFrame, after: DataFrame, periods: DataFrame) -> DataFrame:
    """What a summary gains and loses where the typed lines ``before`` are replaced by ``after``.

    One row per period and order type: the change of ``mrr``, of the ``rows`` behind it and of the
    ``amounts`` among them that are not missing. Lines that stay as they were cancel out before
    they are spread over months. Added up over all changes, counts tell which groups are left, and which have amounts.
    """
    columns = [*PLACE, *VALUE, "ordertype", "gapwithnext"]
    both = after.select(*columns, F.lit(1).alias("weight")).unionByName(
        before.select(*columns, F.lit(-1).alias("weight"))
    )
    weight = F.col("weight")
    counts = [
        F.sum(weight).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("rate").isNotNull(), weight)), F.lit(0)).alias("rated"),
        F.coalesce(F.sum(F.when(F.col("closing").isNotNull(), weight)), F.lit(0)).alias("closed"),
    ]
    sums = _summed(both, counts, weight)
    changed = [F.coalesce(F.col(c), F.lit(0)) != 0 for c in ("rows", "rated", "closed", "rate", "closing")]
    sums = sums.where(changed[0] | changed[1] | changed[2] | changed[3] | changed[4])
    posted = _posted_sums(sums, monthly_periods(periods), month_count(sums))
    last = F.col("period") >= F.col("term")
    return posted.groupBy(*SUMMARY_KEY).agg(
        F.coalesce(F.sum(_posting_amount()), F.lit(0)).cast("decimal(38,2)").alias("mrr"),
        F.sum("rows").alias("rows"),
        F.sum(F.when(last, F.col("closed")).otherwise(F.col("rated"))).alias("amounts"),
    )


def summary_after(changes: DataFrame, ordered: bool = True) -> DataFrame:
    """The summary that all changes add up to."""
    totals = changes.groupBy(*SUMMARY_KEY).agg(
        F.sum("mrr").alias("mrr"), F.sum("rows").alias("rows"), F.sum("amounts").alias("amounts")
    )
    left = totals.where("rows > 0").withColumn("mrr", F.when(F.col("amounts") > 0, F.col("mrr")))
    return _sorted(left, ["periodstart", "ordertype", "postingperiodid"], ordered).select(
        F.col("postingperiod").alias("period"), "ordertype", F.col("mrr").cast("decimal(38,2)").alias("mrr")
    )


def posting_days(typed: DataFrame) -> tuple[Column, Column]:
    """First and last day on which a line or its churn can post; NULL where none does."""
    posts = F.col("tranid").isNotNull() & (F.col("term") > 0)
    churn = F.when(has_churn(), churn_day())
    last = add_months_keep_end(F.col("startdate"), F.ceil("term").cast("int") - 1)
    return F.least(F.when(posts, F.col("startdate")), churn), F.greatest(F.when(posts, last), churn)
