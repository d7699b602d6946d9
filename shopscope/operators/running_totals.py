"""Stored running totals: a run continues from the last day instead of summing history again.

A running sum per key over all days, as one window, puts a key's whole history into one
task and reads it every day.  Here the days are filed in blocks of :data:`BLOCK_DAYS`:

* The rows of a block are one folder, and a small table holds, per block and key, the
  block's total and the sum of all blocks before it.
* :meth:`RunningTotals.add` writes the blocks of the given days only; later blocks keep
  their rows, just the small table of sums is made anew.  Days may arrive late or again:
  what is given for a day replaces what was filed for it.
* :meth:`RunningTotals.running` reads the blocks of the asked days.  Its window is per
  block and key, so a key's history is spread over its blocks.

What belongs to the current version is listed in a manifest that is published last; a
failed run changes nothing and can be repeated.  NULL keys are a key of their own; rows
without a day are left out, as a running total has no place for them.
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_DAYS = 32
_MANIFEST = "block long, path string"


class RunningTotals:
    """Running totals of ``value`` per ``keys`` over ``day``, stored under ``root`` (any Hadoop file-system URI).

    Rows given are one per day and keys; ``value`` is summed as a BIGINT.
    """

    def __init__(self, spark: SparkSession, root: str, day: str, keys: list[str], value: str, block_days: int = BLOCK_DAYS):
        self.spark, self.root = spark, root.rstrip("/")
        self.day, self.keys, self.value, self.block_days = day, keys, value, block_days

    # -- versions --------------------------------------------------------------------
    def _version(self) -> int:
        try:
            return self.spark.read.parquet(f"{self.root}/published").agg(F.max("version")).first()[0]
        except AnalysisException:  # nothing published yet
            return 0

    def _files(self, version: int) -> dict[int, str]:
        """Folder of each block; one entry per :data:`BLOCK_DAYS` days of history."""
        if not version:
            return {}
        return {r["block"]: r["path"] for r in self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/{version}").collect()}

    def _sums(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/sums/{version}")

    def _block(self) -> Column:
        return F.floor(F.unix_date(self.day) / self.block_days).cast("long")

    def _number(self, day: date) -> int:
        return (day - date(1970, 1, 1)).days // self.block_days

    def _rows(self, paths: list[str]) -> DataFrame:
        return self.spark.read.parquet(*paths).select(self.day, *self.keys, self.value, self._block().alias("_block"))

    # -- writing ---------------------------------------------------------------------
    def add(self, counts: DataFrame) -> list[int]:
        """File ``counts`` (day, keys, value), replacing the days it holds; returns the numbers of the blocks written."""
        given = counts.select(F.col(self.day).cast("date").alias(self.day), *self.keys, F.col(self.value).cast("long").alias(self.value))
        given = given.filter(F.col(self.day).isNotNull()).withColumn("_block", self._block())
        touched = sorted(r["_block"] for r in given.select("_block").distinct().collect())  # a number per block of days
        if not touched:
            return []
        version = self._version()
        files = self._files(version)
        old = [files[b] for b in touched if b in files]
        rows = given
        if old:
            rows = rows.unionByName(self._rows(old).join(given.select(self.day).distinct(), self.day, "left_anti").select(*given.columns))
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        by_block = rows.withColumn("block", F.col("_block")).drop("_block")
        by_block.repartition("block").write.partitionBy("block").parquet(path)
        files |= {b: f"{path}/block={b}" for b in touched}

        sums = self._rows([files[b] for b in touched]).groupBy(F.col("_block").alias("block"), *self.keys).agg(F.sum(self.value).alias("total"))
        if version:
            kept = self._sums(version).filter(~F.col("block").isin(touched)).select("block", *self.keys, "total")
            sums = sums.unionByName(kept)
        # One row per block and key: a key's history is a few rows a year here.
        earlier = Window.partitionBy(*self.keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
        sums.write.mode("overwrite").parquet(f"{self.root}/sums/{version + 1}")
        self._listed(sorted(files.items()), _MANIFEST).write.mode("overwrite").parquet(f"{self.root}/manifest/{version + 1}")
        self._listed([(version + 1,)], "version long").write.mode("append").parquet(f"{self.root}/published")
        return touched

    def _listed(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema).coalesce(1)

    # -- reading ---------------------------------------------------------------------
    def _same_keys(self, other: str) -> Column:
        return reduce(Column.__and__, [F.col(f"r.{k}").eqNullSafe(F.col(f"{other}.{k}")) for k in self.keys], F.lit(True))

    def running(self, out: str, first: date | None = None, last: date | None = None) -> DataFrame:
        """(day, keys, value, ``out``) of the days from ``first`` to ``last``: ``out`` sums all days up to the row's."""
        version = self._version()
        files = self._files(version)
        low = self._number(first) if first else None
        high = self._number(last) if last else None
        paths = [p for b, p in sorted(files.items()) if (low is None or b >= low) and (high is None or b <= high)]
        if not paths:
            if not files:
                raise ValueError(f"{self.root} holds no totals yet")
            paths = [next(iter(files.values()))]  # for the schema; no row of it is in the range
        inside = Window.partitionBy("_block", *self.keys).orderBy(self.day).rangeBetween(Window.unboundedPreceding, 0)
        rows = self._rows(paths).withColumn("_inside", F.sum(self.value).over(inside)).alias("r")
        sums = self._sums(version).alias("s")
        if low is not None:
            sums = sums.filter(F.col("block") >= low)
        if high is not None:
            sums = sums.filter(F.col("block") <= high)
        joined = rows.join(sums, (F.col("r._block") == F.col("s.block")) & self._same_keys("s"))
        result = joined.select(F.col(f"r.{self.day}"), *[F.col(f"r.{k}") for k in self.keys], F.col(f"r.{self.value}"), (F.col("s.before") + F.col("r._inside")).alias(out))
        if first:
            result = result.filter(F.col(self.day) >= F.lit(first))
        if last:
            result = result.filter(F.col(self.day) <= F.lit(last))
        return result

    def before(self, day: date, out: str = "opens_before") -> DataFrame:
        """(keys, ``out``): the total of all days before ``day``, from the sums and one block's rows."""
        version, block = self._version(), self._number(day)
        files = self._files(version)
        if not files:
            raise ValueError(f"{self.root} holds no totals yet")
        whole = self._sums(version).filter(F.col("block") < block).select(*self.keys, F.col("total").alias(out))
        if block in files:
            part = self._rows([files[block]]).filter(F.col(self.day) < F.lit(day)).select(*self.keys, F.col(self.value).alias(out))
            whole = whole.unionByName(part)
        return whole.groupBy(*self.keys).agg(F.sum(out).alias(out))
