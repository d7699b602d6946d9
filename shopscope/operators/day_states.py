"""Rolling customer summaries (C7, C8) from stored, mergeable day states.

The customer view is rebuilt every day from a year of sales.  Its flags are
maxima and its windows move, so a day that leaves cannot be subtracted; but the
parts of a window can be merged.  This module keeps, per customer, the partial
summary of each day and of each block of 2, 4, 8, ... days, and a run merges the
few blocks that make up its window:

* A *state* is what one customer's lines of some days add up to: the masks
  ``seen`` / ``seen_not``, the text maximum of the kids date as a number, sums and
  counts.  Merging is ``bit_or``, ``max`` and ``sum``: in any order, any grouping.
* Lines count for the day that their window tests: store sales and kids sales for
  the transaction day, online sales for the order day.  The three *streams* are kept
  apart, since their windows differ.
* :meth:`DayStates.add_day` reads the facts of one new day only, writes their states
  by window day (level 0) and completes the blocks that end by then, each from its
  two halves.  A line that arrives late is a further part of its day; blocks built
  before it do not hold it, and readers take it besides.
* :meth:`DayStates.summary` covers each window, from its first day to the newest, by
  the largest complete blocks: at most twice the logarithm of the days, some 17 for a year.

All states are Parquet folders under one root.  What belongs to the current version is
listed in a manifest that is published last, so a failed run changes nothing and can be
repeated.  Adding a day again is refused, or with ``replace`` exchanges what it added and
rebuilds the blocks that held it.

Flags are those of the items on the day their lines were added; after a change of the
item table that should reach back, run :meth:`DayStates.backfill` on a new root.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import dates
from .segments import _has, clamped_sales, unpacked_summary, with_item_flags

STORE, ONLINE, KIDS = "store", "online", "kids"
#: The longest blocks: 2 ** LEVELS days.
LEVELS = 9
_EPOCH = date(1970, 1, 1)
_MANIFEST = "level int, block long, path string, source string, version long"


def day_number(day: date) -> int:
    return (day - _EPOCH).days


def merged(states: DataFrame, *keys: str) -> DataFrame:
    """One state per customer, stream and ``keys``."""
    return states.groupBy(*keys, "customer_id", "stream").agg(
        F.bit_or("seen").alias("seen"),
        F.bit_or("seen_not").alias("seen_not"),
        F.max("kids_key").alias("kids_key"),
        F.sum("sales").cast("decimal(38,4)").alias("sales"),
        F.sum("lines").alias("lines"),
    )


def line_states(fact_sales: DataFrame, dim_item: DataFrame, max_items: int = 4_000_000) -> DataFrame:
    """States of the lines of ``fact_sales`` by window day: (block, customer_id, stream, state).

    A line takes part in up to two streams; lines without the day that its stream
    tests are in no window.
    """
    number = lambda c: F.unix_date(F.to_date(c)).cast("long")
    lines = fact_sales.filter(F.col("loyalty_flag") == 1).select(
        "customer_id", "item_id", "online_sale", "transaction_date_time", "ordered_date", "aud_sales"
    )
    lines = with_item_flags(lines, dim_item, max_items)
    bought, ordered = number("transaction_date_time"), number("ordered_date")
    main = F.when(F.col("online_sale") == 1, F.struct(F.lit(ONLINE).alias("stream"), ordered.alias("block"))).when(
        F.col("online_sale") == 0, F.struct(F.lit(STORE).alias("stream"), bought.alias("block"))
    )
    kids = F.when(_has(F.col("mask"), "kids"), F.struct(F.lit(KIDS).alias("stream"), bought.alias("block")))
    entries = lines.select("*", F.explode(F.array(main, kids)).alias("at")).filter(F.col("at.block").isNotNull())
    own = F.col("at.stream") != KIDS
    states = entries.select(
        "customer_id",
        F.col("at.stream").alias("stream"),
        F.col("at.block").alias("block"),
        F.when(own, F.col("mask")).alias("seen"),
        F.when(own, F.bitwise_not("mask")).alias("seen_not"),
        F.when(own & _has(F.col("mask"), "kids_div"), dates.ddmmyyyy_key(F.col("transaction_date_time"))).alias("kids_key"),
        clamped_sales().alias("sales"),
        F.lit(1).cast("long").alias("lines"),
    )
    return merged(states, "block")


@dataclass(frozen=True)
class Part:
    """A folder with states of one block; ``version`` is the manifest that first listed it."""

    level: int
    block: int
    path: str
    source: str
    version: int

    @property
    def first(self) -> int:
        return self.block << self.level

    @property
    def last(self) -> int:
        return ((self.block + 1) << self.level) - 1


class DayStates:
    """The stored states under ``root`` (any Hadoop file-system URI).

    A block is written by ``files`` tasks into as many files, its customers dealt out
    by hash; set it to the states of a usual day divided by some five million.
    """

    def __init__(self, spark: SparkSession, root: str, files: int = 1):
        self.spark = spark
        self.files = files
        self.root = root.rstrip("/")

    # -- manifest ------------------------------------------------------------------
    def _current(self) -> tuple[int, list[Part]]:
        from pyspark.errors import AnalysisException

        try:
            version = self.spark.read.parquet(f"{self.root}/published").agg(F.max("version")).first()[0]
        except AnalysisException:  # nothing published yet
            return 0, []
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/{version}").collect()
        return version, [Part(*r) for r in rows]

    def _publish(self, version: int, parts: list[Part]) -> None:
        rows = [(p.level, p.block, p.path, p.source, p.version) for p in parts]
        listed = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.root}/manifest/{version}")
        self.spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{self.root}/published")

    def days(self) -> list[str]:
        """The days added so far (ISO text), with ``backfill`` for a first load."""
        return sorted({p.source for p in self._current()[1] if p.level == 0})

    # -- writing -------------------------------------------------------------------
    def _write(self, states: DataFrame, source: str, version: int) -> list[Part]:
        """Write ``states`` by level and block and list the blocks that got rows."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = states.repartition(tasks, "level", "block", F.pmod(F.xxhash64("customer_id"), F.lit(self.files)))
        dealt.write.partitionBy("level", "block").parquet(path)
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{path}/level=*/block=*")
        found = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(where)
        parts = []
        for status in found:
            block, level = status.getPath().getName(), status.getPath().getParent().getName()
            number = int(level.removeprefix("level="))
            made_of = "built" if number else source
            parts.append(Part(number, int(block.removeprefix("block=")), f"{path}/{level}/{block}", made_of, version))
        return sorted(parts, key=lambda p: (p.level, p.block))

    def _read(self, parts: list[Part]) -> DataFrame:
        """The states of ``parts`` with the block each is filed under."""
        schema = T.StructType(
            [
                T.StructField("customer_id", T.LongType()),
                T.StructField("stream", T.StringType()),
                T.StructField("seen", T.IntegerType()),
                T.StructField("seen_not", T.IntegerType()),
                T.StructField("kids_key", T.IntegerType()),
                T.StructField("sales", T.DecimalType(38, 4)),
                T.StructField("lines", T.LongType()),
            ]
        )
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("first", T.LongType())]))
        frames = []
        for level in sorted({p.level for p in parts}):
            own = self.spark.read.schema(schema).parquet(*[p.path for p in parts if p.level == level])
            block = F.regexp_extract(F.col("_metadata.file_path"), r"/block=(-?[0-9]+)/", 1).cast("long")
            frames.append(own.withColumn("first", F.shiftleft(block, level)))
        return reduce(DataFrame.unionAll, frames)

    @staticmethod
    def _held(parts: list[Part], block: Part) -> list[Part]:
        """The late parts of a built block's days, which it does not hold."""
        return [p for p in parts if p.level == 0 and p.version > block.version and block.first <= p.block <= block.last]

    def _cover(self, parts: list[Part], first: int, last: int) -> list[Part]:
        """Parts whose states together are those of the days from ``first`` to ``last``, by the largest blocks."""
        built = {(p.level, p.block): p for p in parts if p.level}
        days: dict[int, list[Part]] = {}
        for p in parts:
            if p.level == 0:
                days.setdefault(p.block, []).append(p)
        chosen, at = [], first
        while at <= last:
            for level in range(LEVELS, 0, -1):
                block = built.get((level, at >> level))
                if block is not None and block.first == at and block.last <= last:
                    chosen += [block, *self._held(parts, block)]
                    at = block.last + 1
                    break
            else:
                chosen += days.get(at, [])
                at += 1
        return chosen

    def _build_blocks(self, parts: list[Part], last: int, version: int) -> list[Part]:
        """``parts`` with every block that ends by ``last``, holds a day and is not built yet; one job per level."""
        parts = list(parts)
        for level in range(1, LEVELS + 1):
            built = {p.block for p in parts if p.level == level}
            wanted = {p.block >> level for p in parts if p.level == 0} - built
            wanted = {b for b in wanted if ((b + 1) << level) - 1 <= last}
            if not wanted:
                continue
            halves = [p for b in sorted(wanted) for p in self._cover(parts, b << level, ((b + 1) << level) - 1)]
            states = self._read(halves).withColumn("block", F.shiftright("first", level)).drop("first")
            parts += self._write(merged(states, "block").withColumn("level", F.lit(level)), "built", version)
        return parts

    def add_day(self, facts: DataFrame, dim_item: DataFrame, day: date, replace: bool = False) -> None:
        """Add the fact lines that arrived on ``day``.

        ``facts`` are that day's lines only (a stored fact: its ``sale_day``
        partition); their window days may be earlier.
        """
        version, parts = self._current()
        source = day.isoformat()
        if any(p.source == source for p in parts):
            if not replace:
                raise ValueError(f"{source} has been added; pass replace=True to exchange it")
            touched = {p.block for p in parts if p.source == source}
            parts = [
                p for p in parts if p.source != source and not (p.level and any(p.first <= b <= p.last for b in touched))
            ]
        states = line_states(facts, dim_item).withColumn("level", F.lit(0))
        parts = parts + self._write(states, source, version + 1)
        parts = self._build_blocks(parts, day_number(day), version + 1)
        self._publish(version + 1, parts)

    def backfill(self, facts: DataFrame, dim_item: DataFrame, day: date) -> None:
        """A first load: all lines that arrived until ``day``, the blocks of all levels in one pass."""
        version, parts = self._current()
        if parts:
            raise ValueError(f"{self.root} holds states; backfill a new root")
        states = line_states(facts, dim_item).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
        end = F.expr("shiftleft(shiftright(block, level) + 1, level) - 1")
        states = states.filter((F.col("level") == 0) | (end <= day_number(day)))
        states = states.withColumn("block", F.expr("shiftright(block, level)"))
        self._publish(version + 1, self._write(merged(states, "level", "block"), "backfill", version + 1))

    def expire(self, first: date) -> int:
        """Forget all parts that end before ``first``; returns how many."""
        version, parts = self._current()
        kept = [p for p in parts if p.last >= day_number(first)]
        if len(kept) < len(parts):
            self._publish(version + 1, kept)
        return len(parts) - len(kept)

    # -- reading -------------------------------------------------------------------
    def window_parts(self, as_of: datetime) -> dict[str, list[Part]]:
        """The parts that each stream's window reads."""
        _, parts = self._current()
        newest = max((p.last for p in parts if p.level == 0), default=-1)
        back = {STORE: C.SCV_STORE_DAYS, ONLINE: C.SCV_ONLINE_DAYS, KIDS: C.KIDS_DAYS}
        return {s: self._cover(parts, day_number(dates.days_back_bound(as_of, n)), newest) for s, n in back.items()}

    def summary(self, as_of: datetime) -> DataFrame:
        """What :func:`~shopscope.operators.segments.fact_summary` gives, from the states.

        Customers without a line that counts for C7 or C8 have no row.
        """
        groups: dict[tuple[Part, ...], list[str]] = {}
        for stream, parts in self.window_parts(as_of).items():
            groups.setdefault(tuple(parts), []).append(stream)
        read = [self._read(list(p)).filter(F.col("stream").isin(*s)) for p, s in groups.items()]
        states = reduce(DataFrame.unionAll, read)
        own, kids = F.col("stream") != KIDS, F.col("stream") == KIDS
        per_customer = states.groupBy("customer_id").agg(
            dates.ddmmyyyy_text(F.max(F.when(own, F.col("kids_key")))).alias("Transacted_KIDS"),
            F.bit_or(F.when(own, F.col("seen"))).alias("seen"),
            F.bit_or(F.when(own, F.col("seen_not"))).alias("seen_not"),
            F.sum(F.when(own, F.col("sales"))).alias("AUDSales"),
            F.sum(F.when(kids, F.col("sales"))).alias("kids_AUDSales"),
            F.coalesce(F.sum(F.when(own, F.col("lines"))), F.lit(0)).alias("n_summary_lines"),
            F.coalesce(F.sum(F.when(kids, F.col("lines"))), F.lit(0)).alias("n_kids_lines"),
        )
        return unpacked_summary(per_customer)
