"""Small helpers shared by the corpus operators: shared folders, written tables, prefix sums."""

from __future__ import annotations

import ctypes
import gc
import threading
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows per block of the two-level running sum in :func:`with_offsets`.
OFFSET_BLOCK = 4096


#: Rows in one Arrow batch: whole texts go through it, and buffers exist on both sides of each running task.
ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let the session exchange at most ARROW_ROWS rows at a time with Python workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Only where that setting is missing (a local session, as in tests) a
    folder beside the warehouse is used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm_checkpoints"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    ``by``: a column with few values, each of which gets its own folder, so
    that a filter on it reads that folder only.  The written table cuts the lineage, survives lost executors and keeps a
    costly stage from being computed once per reader.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.mode("error").parquet(path, partitionBy=by)
    found = spark.read.schema(df.schema).parquet(path)
    if Scratch.open():
        Scratch.open()[-1].tables.append((found, path))
    return found


class Scratch:
    """Tables written for one run of an operator, and removed as soon as nothing reads them any more.

    Holds the tables of :meth:`keep` and, inside a ``with`` block, those of :func:`stored`.
    A removed table is never needed again: whatever was made of it has itself been
    written.  Tables that are left go to the enclosing block, if there is one.
    """

    _local = threading.local()

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: list[tuple[DataFrame, str]] = []

    @classmethod
    def open(cls) -> list[Scratch]:
        """The blocks that this thread is in."""
        if not hasattr(cls._local, "blocks"):
            cls._local.blocks = []
        return cls._local.blocks

    def __enter__(self) -> Scratch:
        self.open().append(self)
        return self

    def __exit__(self, *_) -> None:
        self.open().remove(self)
        if self.open():
            self.open()[-1].tables += self.tables

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, written as Parquet into the shared folder and read back."""
        path = shared_folder(self.spark)
        df.write.mode("error").parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((found, path))
        return found

    def drop(self, *tables: DataFrame) -> None:
        """Remove these tables of :meth:`keep`, and the shuffle files of the finished steps."""
        for table, path in self.tables:
            if any(table is t for t in tables):
                remove_folder(self.spark, path)
        self.tables = [(t, p) for t, p in self.tables if not any(t is x for x in tables)]
        release_shuffles(self.spark)

    def drop_all_but(self, *tables: DataFrame) -> None:
        """Remove all other tables."""
        self.drop(*[t for t, _ in self.tables if not any(t is x for x in tables)])


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store that this library has written."""
    jvm = getattr(spark, "_jvm", None)  # a remote session has none: its server clears the folder
    if jvm is not None:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps now.

    It removes them once the driver's JVM has found that nothing refers to them; a
    driver with little to do may not look for hours, while the disks fill up.
    """
    gc.collect()
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        jvm.System.gc()


def give_back(run):
    """``run``, a function of batches for Python workers, returning its memory to the system when it ends.

    Spark uses a worker for one task after another, also of later stages; what one
    stage has freed would otherwise still count beside what the next one needs.
    """

    def whole(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not glibc
            pass

    return whole


def text_or_empty(column: str = "text"):
    """The text of a row, the empty string where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_remainder(column, modulus: int):
    """crc32 of the id written as decimal text, modulo ``modulus`` (null id: null)."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def with_offsets(sizes: DataFrame, key: str, value: str, out: str = "start") -> DataFrame:
    """``sizes`` (one row per dense integer ``key``) with the exclusive running sum of ``value``.

    Two levels: a window inside blocks of :data:`OFFSET_BLOCK` keys and one
    over the block totals, so no task sorts more than one row per block.
    """
    block = F.floor(F.col(key) / F.lit(OFFSET_BLOCK)).alias("_block")
    rows = sizes.select(key, value, block)
    totals = rows.groupBy("_block").agg(F.sum(value).alias("_total"))
    before = F.sum("_total").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = totals.select("_block", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum(value).over(Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_inside", F.coalesce(inside, F.lit(0)))
    return rows.join(blocks, "_block").select(key, value, (F.col("_inside") + F.col("_before")).cast("long").alias(out))


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): one row (id, component_id), the smallest reachable id.

    Hash-to-min label propagation with pointer jumping; every round is a join
    and a grouped minimum on Spark, written to the shared folder.  Links of
    one hub are pre-aggregated by the map-side minimum.  Ids without a link
    do not appear.
    """
    edges = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    )
    labels = stored(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"))
    while True:
        around = edges.join(labels, edges["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(around, labels["id"] == around["a"]).select("id", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("label").alias("jumped"))
        after = stored(
            step.join(jump, "low").select("id", F.col("label").alias("old"), F.least("low", "jumped").alias("label"))
        )
        changed = after.where("old <> label").limit(1).count()
        release_shuffles(links.sparkSession)
        labels = after.select("id", "label")
        if not changed:
            return labels.select("id", F.col("label").alias("component_id"))


#: Bytes of rows gathered in one output batch of :func:`sized_batches`.
BATCH_BYTES = 4 << 20


def sized_batches(rows, schema: pa.Schema):
    """``rows`` (pairs of a tuple and its size in bytes) as Arrow batches of about :data:`BATCH_BYTES` bytes."""
    held: list[tuple] = []
    size = 0
    for row, more in rows:
        held.append(row)
        size += more + 64
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
