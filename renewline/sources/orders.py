"""Contract tables derived from the order, customer and part tables.

The order tables hold no contracts. Every order becomes one contract line by a
fixed rule, so contract lines grow with the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns read, so that opening a table starts no job to find its schema.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_acctbal double",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "lineitem": "l_orderkey bigint",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def contract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order; terms of 3, 6, 12, 3.5 and half a month by order key.

    Whole months run to the day before they repeat, half a month runs 15 days.
    """
    start = "if(o_orderkey % 4 = 0, cast(o_orderdate as date), trunc(cast(o_orderdate as date), 'MM'))"
    months = "case o_orderkey % 5 when 1 then 6 when 2 then 12 when 4 then 0 else 3 end"
    term = (
        "cast(case o_orderkey % 5 when 0 then 3.0 when 1 then 6.0 when 2 then 12.0"
        " when 3 then 3.5 else 0.5 end as decimal(12,6))"
    )
    days = "if(o_orderkey % 5 >= 3, 14, -1)"
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as line_id",
        "o_orderkey as tranid",
        "o_custkey as customerid",
        "o_orderkey % 3 as itemid",
        "cast(o_orderkey as string) as contractid",
        f"{start} as startdate",
        f"date_add(add_months({start}, {months}), {days}) as enddate",
        f"{term} as term",
        "cast(o_totalprice as decimal(18,2)) as amount",
    )


def accounting_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months, quarters and years from the first start to the last end.

    Ids are the year and month (199501), year and quarter (19951) or year.
    """
    years = contract_lines(spark, sf_dir).selectExpr(
        "trunc(min(startdate), 'YEAR') as first_day",
        "add_months(trunc(max(date_add(enddate, 1)), 'YEAR'), 11) as last_month",
    )
    months = years.selectExpr("explode(sequence(first_day, last_month, interval 1 month)) as startdate")

    def period(number: str, name: str, length: int, isquarter: str, isyear: str) -> str:
        return (
            f"struct(cast({number} as int) as id, {name} as periodname, startdate,"
            f" date_sub(add_months(startdate, {length}), 1) as enddate,"
            f" '{isquarter}' as isquarter, '{isyear}' as isyear)"
        )

    month = period(
        "year(startdate) * 100 + month(startdate)", "date_format(startdate, 'MMM yyyy')", 1, "F", "F"
    )
    quarter = period(
        "year(startdate) * 10 + quarter(startdate)",
        "concat('Q', quarter(startdate), ' ', year(startdate))",
        3,
        "T",
        "F",
    )
    year = period("year(startdate)", "concat('FY ', year(startdate))", 12, "F", "T")
    return months.selectExpr(
        f"""inline(case when month(startdate) = 1 then array({month}, {quarter}, {year})
                        when month(startdate) % 3 = 1 then array({month}, {quarter})
                        else array({month}) end)"""
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth customer is a person, every second of those without first name."""
    return read(spark, sf_dir, "customer").selectExpr(
        "c_custkey as id",
        "if(c_custkey % 4 = 0 and c_custkey % 8 <> 0, substring_index(c_name, '#', 1), null) as firstname",
        "if(c_custkey % 4 = 0, substring_index(c_name, '#', -1), null) as lastname",
        "if(c_custkey % 4 = 0, 'T', 'F') as isperson",
        "if(c_custkey % 4 = 0, null, c_name) as companyname",
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey as id", "p_name as displayname", "concat('Part ', p_partkey) as display"
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as id",
        "concat('Order #', o_orderkey) as trandisplayname",
        "concat('#', o_orderkey) as display",
    )


def hard_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract lines with the cases that real ones have and orders lack.

    A third of all lines makes one timeline, some lines occur twice, some
    transactions have several lines; keys, dates and terms are missing; terms
    are zero, negative, or fractional beyond all others; starts fall on month ends.
    """
    day = "cast(o_orderdate as date)"
    start = f"case when k % 6 = 0 then last_day({day}) when k % 4 = 0 then {day} else trunc({day}, 'MM') end"
    months = "case k % 5 when 1 then 6 when 2 then 12 when 4 then 0 else 3 end"
    days = "if(k % 5 >= 3, 14, -1)"
    term = (
        "cast(case when k % 29 = 0 then null when k % 31 = 0 then 0.0 when k % 37 = 0 then -1.0"
        " when k % 41 = 0 then 14.5 else case k % 5 when 0 then 3.0 when 1 then 6.0 when 2 then 12.0"
        " when 3 then 3.5 else 0.5 end end as decimal(12,6))"
    )
    rows = read(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "*")
    twice = rows.selectExpr("*", "explode(if(k % 10 = 1, array(0, 1), array(0))) as copy")
    return twice.selectExpr(
        "k as line_id",
        "case when k % 11 = 0 then null when k % 26 = 3 then k - 1 else k end as tranid",
        "case when k % 13 = 0 then null when k % 3 = 0 then 1 else o_custkey end as customerid",
        "case when k % 17 = 0 then null when k % 3 = 0 then 1 else k % 7 end as itemid",
        "cast(k as string) as contractid",
        f"if(k % 19 = 0, null, {start}) as startdate",
        f"if(k % 23 = 0, null, date_add(add_months({start}, {months}), {days})) as enddate",
        f"{term} as term",
        "cast(o_totalprice as decimal(18,2)) as amount",
    )


def hard_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periods of the orders, and one that overlaps two months."""
    extra = spark.range(1).selectExpr(
        "cast(99 as int) as id",
        "'Stub' as periodname",
        "date'1997-03-10' as startdate",
        "date'1997-04-20' as enddate",
        "'F' as isquarter",
        "'F' as isyear",
    )
    return accounting_periods(spark, sf_dir).unionByName(extra)
