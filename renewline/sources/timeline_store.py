"""Typed contract lines on disk, kept up to date as lines are appended.

Lines are stored with their previous contract, gaps and order type, in folders by a hash of customer and item, each
file sorted by the first day on which its lines post. An append reads the folders of its timelines, orders those timelines
again and replaces these folders; what the summary gains and loses goes into a small table of changes. A report
of some periods reads the lines that post in them only: their first and last posting days are filters of the scan.

The change is written first, and once per named batch; replacing the folders can then be repeated at
will, as lines are known by their ids. So an append that failed anywhere is simply run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renewline.operators.maintenance import hot_in_either, reorder, touched
from renewline.operators.timeline import GAPS, KEY
from renewline.plans import reports
from renewline.sources.files import FileSystem
from renewline.sources.schemas import CONTRACT_LINES

TYPED = T.StructType(
    [
        *CONTRACT_LINES.fields,
        T.StructField("previousenddate", T.DateType()),
        T.StructField("previoustranid", T.LongType()),
        *(T.StructField(c, T.IntegerType()) for c in GAPS),
        T.StructField("ordertype", T.StringType()),
        T.StructField("firstday", T.DateType()),
        T.StructField("lastday", T.DateType()),
    ]
)
STORED = T.StructType([*TYPED.fields, T.StructField("bucket", T.IntegerType())])
CHANGES = (
    "postingperiodid int, postingperiod string, periodstart date, ordertype string, mrr decimal(38,2), "
    "rows long, amounts long"
)
#: Files that the lines of a folder are spread over, so that a huge timeline is not written by one task.
FILES = 8


class TimelineStore:
    """A folder of typed lines and changes. ``buckets`` must be the same for all appends."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self._fs = FileSystem(spark, path)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*KEY), F.lit(self.buckets)).cast("int").alias("bucket")

    def lines(self) -> DataFrame:
        """All typed lines."""
        folder = f"{self.path}/typed"
        if not self._fs.names(folder):
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).parquet(folder)

    def append(self, batch: DataFrame, periods: DataFrame, name: str, **options) -> None:
        """Add contract lines; ``name`` stands for the batch and must be another for other lines.

        ``batch`` is read several times, so it should be stored. ``options`` go to the timeline operators; unless they
        name the ``hot`` timelines, those too big for one task are searched.
        """
        batch = batch.select(*CONTRACT_LINES.names)
        # At most as many numbers as there are buckets.
        buckets = [r["bucket"] for r in batch.select(self._bucket()).distinct().collect()]
        if not buckets:
            return
        stored = self.lines().where(F.col("bucket").isin(buckets))
        big = None
        if isinstance(options.get("hot", "detect"), str):
            # One search serves the timeline operators and the look-up of stored lines.
            big = options["hot"] = hot_in_either(stored, batch)
        before, after = reorder(stored, batch, big, **options)
        change = f"{self.path}/changes/{name}"
        if not self._fs.exists(f"{change}/_SUCCESS"):
            reports.summary_changes(before, after, periods).coalesce(1).write.mode("overwrite").parquet(change)
        kept, _ = touched(stored, batch, big)
        first, last = reports.posting_days(after)
        after = after.select("*", first.alias("firstday"), last.alias("lastday"), self._bucket())
        rows = kept.select(*STORED.names).unionByName(after.select(*STORED.names))
        spread = F.pmod(F.xxhash64("line_id"), F.lit(FILES))
        (
            rows.repartition("bucket", spread)
            .sortWithinPartitions("bucket", "firstday")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(f"{self.path}/typed")
        )

    def changes(self) -> DataFrame:
        """The changes of all appends that are complete."""
        folder = f"{self.path}/changes"
        done = [f"{folder}/{n}" for n in self._fs.names(folder) if self._fs.exists(f"{folder}/{n}/_SUCCESS")]
        return self.spark.read.schema(CHANGES).parquet(*done) if done else self.spark.createDataFrame([], CHANGES)

    def summary(self, ordered: bool = True) -> DataFrame:
        """``report_summary`` of all lines, from the changes alone."""
        return reports.summary_after(self.changes(), ordered)

    def posting_between(self, periods: DataFrame, between: reports.Days) -> DataFrame:
        """The typed lines that can post in the periods that start in a window, by filters that reach the files."""
        days = reports.months_starting(periods, between).agg(F.min("startdate"), F.max("enddate")).first()
        low, high = (F.lit(day).cast("date") for day in days)
        return self.lines().where((F.col("firstday") <= high) & (F.col("lastday") >= low))

    def summary_between(self, periods: DataFrame, between: reports.Days, ordered: bool = True) -> DataFrame:
        """``report_summary`` of the periods that start in a window."""
        return reports.summarise(self.posting_between(periods, between), periods, between, ordered=ordered)
