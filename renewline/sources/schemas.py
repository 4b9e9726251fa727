"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

CONTRACT_LINES = T.StructType(
    [
        T.StructField("line_id", T.LongType(), False),
        T.StructField("tranid", T.LongType()),
        T.StructField("customerid", T.LongType()),
        T.StructField("itemid", T.LongType()),
        T.StructField("contractid", T.StringType()),
        T.StructField("startdate", T.DateType()),
        T.StructField("enddate", T.DateType()),
        T.StructField("term", T.DecimalType(12, 6)),
        T.StructField("amount", T.DecimalType(18, 2)),
    ]
)

ACCOUNTING_PERIODS = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("periodname", T.StringType()),
        T.StructField("startdate", T.DateType()),
        T.StructField("enddate", T.DateType()),
        T.StructField("isquarter", T.StringType()),
        T.StructField("isyear", T.StringType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("firstname", T.StringType()),
        T.StructField("lastname", T.StringType()),
        T.StructField("isperson", T.StringType()),
        T.StructField("companyname", T.StringType()),
    ]
)

ITEMS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("displayname", T.StringType()),
        # How a reference to the item is shown; its name can differ.
        T.StructField("display", T.StringType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("trandisplayname", T.StringType()),
        # How a reference to the transaction is shown; its name can differ.
        T.StructField("display", T.StringType()),
    ]
)
