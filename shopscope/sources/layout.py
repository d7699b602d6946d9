"""Storage layout for the large inputs: bucketed and date-partitioned tables.

The biggest shuffle of the reports is the sale fact by ``customer_id``
(per-customer summary, per-customer profile sales).  Stored bucketed by
``customer_id``, the fact is read already hash-partitioned by customer, so
those aggregations and the joins to the customer base need no exchange on
the fact side.

The rolling windows test the order date or the transaction date, depending on
the channel.  A fact stored with :func:`save_fact` is partitioned by
``sale_day``, the later of the two, and every window adds the wider condition
``sale_day >= first day`` (:func:`since_day`): whole days are skipped, and a
row stays in whenever either of its dates reaches the window.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Partition column of a fact stored by day.
SALE_DAY = "sale_day"


def with_sale_day(fact_sales: DataFrame) -> DataFrame:
    """The fact with its partition column: the later of order and transaction date."""
    day = F.greatest(F.to_date("transaction_date_time"), F.to_date("ordered_date"))
    return fact_sales.withColumn(SALE_DAY, day)


def since_day(fact_sales: DataFrame, first: date | datetime) -> DataFrame:
    """Rows that a window from ``first`` on may need, pruned by partition where the fact is stored by day."""
    if SALE_DAY not in fact_sales.columns:
        return fact_sales
    day = first.date() if isinstance(first, datetime) else first
    return fact_sales.filter(F.col(SALE_DAY) >= F.lit(day))


def save_fact(fact_sales: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Store the sale fact partitioned by day and, within a day, bucketed by customer."""
    save_bucketed(with_sale_day(fact_sales), table, "customer_id", buckets, path, [SALE_DAY])


def save_bucketed(
    df: DataFrame,
    table: str,
    by: str,
    buckets: int,
    path: str | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Write ``df`` as a parquet table bucketed (and sorted) by ``by``.

    ``buckets`` should match ``spark.sql.shuffle.partitions`` of the jobs
    that join on ``by`` (or let Spark coalesce buckets), and be sized so a
    bucket file is ~128 MB-1 GB.  ``path`` makes it an external table at a
    shared location; ``partition_by`` adds date (or other) directories.  Rows
    are first dealt out by directory and bucket, so that each bucket of a
    directory is one file, written by one task.
    """
    # The number of a bucket is this hash, so a task has whole buckets.
    bucket = F.pmod(F.hash(by), F.lit(buckets))
    df = df.repartition(*(partition_by or []), bucket)
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, by).sortBy(by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
