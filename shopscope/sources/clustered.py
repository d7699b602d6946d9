"""A fact filed by two dates at once, so that a window on either skips files.

The windows of the reports test the order date for one channel and the transaction date
for the other.  A table sorted by one date can skip files for that date only.  Here the
bits of both days are interleaved into one number, the fact is cut into files along it,
and each file then covers a small range of *both* days.  A small table beside the files
lists their ranges; a window reads the files it can meet and no other, and inside these
the rows are in the same order, so that row groups are skipped as well.

A NULL date lies in no window: a file without any value of a date has no range for it.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates

#: The two dates of the sale fact.
ORDERED, TRANSACTED = "ordered_date", "transaction_date_time"


def _spread(day: Column) -> Column:
    """The 16 bits of a day number (from -32768 to 32767 days around 1970), a zero between each."""
    x = F.greatest(F.lit(0), F.least(F.lit(65535), F.coalesce(day, F.lit(0)) + 32768)).cast("long")
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def interleaved(first: str, second: str) -> Column:
    """One number per pair of days; near numbers are near in both days."""
    a, b = (_spread(F.unix_date(F.to_date(c))) for c in (first, second))
    return F.shiftleft(a, 1).bitwiseOR(b)


class ClusteredFact:
    """The sale fact under ``root`` (any Hadoop file-system URI), clustered by order and transaction day."""

    def __init__(self, spark: SparkSession, root: str, first: str = ORDERED, second: str = TRANSACTED):
        self.spark, self.root = spark, root.rstrip("/")
        self.first, self.second = first, second

    def save(self, fact: DataFrame, files: int) -> None:
        """Write ``fact`` into some ``files`` files of like size and list their ranges.

        Rows of one pair of days may be in several files (a hash of the row settles
        ties), so a very busy day is no larger task than others.
        """
        key = interleaved(self.first, self.second)
        tie = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
        keyed = fact.withColumn("_key", key).withColumn("_tie", tie)
        # Sorted within the file, then the keys are dropped before the write.
        dealt = keyed.repartitionByRange(files, "_key", "_tie").sortWithinPartitions("_key", "_tie").drop("_key", "_tie")
        dealt.write.mode("overwrite").parquet(f"{self.root}/data")
        rows = self.spark.read.parquet(f"{self.root}/data").select(F.col("_metadata.file_path").alias("file"), self.first, self.second)
        day = {c: F.to_date(c) for c in (self.first, self.second)}
        ranges = rows.groupBy("file").agg(
            F.min(day[self.first]).alias("first_from"),
            F.max(day[self.first]).alias("first_to"),
            F.min(day[self.second]).alias("second_from"),
            F.max(day[self.second]).alias("second_to"),
            F.count(F.lit(1)).alias("n"),
        )
        ranges.write.mode("overwrite").parquet(f"{self.root}/ranges")

    def files(self, first_since: date | None = None, second_since: date | None = None) -> list[str]:
        """Files with rows whose first date is on or after ``first_since`` or whose second is on or after ``second_since``.

        A date that is not given selects nothing by itself; without any, all files.
        The list has an entry per file, as the scan itself needs it.
        """
        ranges = self.spark.read.parquet(f"{self.root}/ranges")
        if first_since is not None or second_since is not None:
            hit = F.lit(False)
            if first_since is not None:
                hit = hit | F.coalesce(F.col("first_to") >= F.lit(first_since), F.lit(False))
            if second_since is not None:
                hit = hit | F.coalesce(F.col("second_to") >= F.lit(second_since), F.lit(False))
            ranges = ranges.filter(hit)
        return sorted(r["file"] for r in ranges.select("file").collect())

    def read(self, first_since: date | None = None, second_since: date | None = None) -> DataFrame:
        """The fact's rows that meet either condition, from the files that can hold one."""
        schema = self.spark.read.parquet(f"{self.root}/data").schema
        paths = self.files(first_since, second_since)
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*paths)
        tests = [dates.on_or_after(F.col(c), d) for c, d in ((self.first, first_since), (self.second, second_since)) if d is not None]
        return rows.filter(tests[0] | tests[1]) if len(tests) == 2 else rows.filter(tests[0]) if tests else rows

    def summary_rows(self, as_of: datetime) -> DataFrame:
        """All rows that the purchase and kids summaries of a run may count."""
        ordered = dates.days_back_bound(as_of, C.SCV_ONLINE_DAYS)
        bought = dates.days_back_bound(as_of, max(C.SCV_STORE_DAYS, C.KIDS_DAYS))
        return self.read(ordered, bought)
