"""Exact distinct users over any days, from one bitmap a day and country.

``count(DISTINCT user)`` of a range cannot be added up from daily counts.  Here users
get dense numbers once, and a day keeps the set of its users as bitmaps of 32,768
numbers (4 KB, only those that are not empty).  Sets merge by OR: any range, trade week
or group of countries is counted from the stored days without the events.

Numbers are dealt by hash bucket, ordered by name within a bucket and moved up by the
sizes of the buckets before: no task sorts more than one bucket, and the same users get
the same numbers again.  Later users follow after the highest number given
(:func:`number_users` with ``known``), so stored bitmaps stay valid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets of users, numbered by themselves.
BUCKETS = 4096


def number_users(users: DataFrame, known: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(user, user_no) of all users of the one-column frame, from 1 without gaps; NULL is no user.

    ``known`` are numbers given before; they are kept, and returned too.
    """
    name = users.columns[0]
    fresh = users.select(F.col(f"`{name}`").alias("user")).filter(F.col("user").isNotNull()).distinct()
    start = F.lit(0).cast("long")
    if known is not None:
        fresh = fresh.join(known.select("user"), "user", "left_anti")
        start = F.lit(known.agg(F.coalesce(F.max("user_no"), F.lit(0))).first()[0]).cast("long")
    fresh = fresh.withColumn("bucket", F.pmod(F.xxhash64("user"), F.lit(buckets)))
    sizes = fresh.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most one row per bucket
    starts = sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("user"))
    numbered = fresh.withColumn("inside", inside).join(F.broadcast(starts), "bucket")
    numbered = numbered.select("user", (start + F.col("base") + F.col("inside")).alias("user_no"))
    return numbered if known is None else known.select("user", "user_no").unionByName(numbered)


def day_bitmaps(rows: DataFrame, numbers: DataFrame, keys: list[str], user: str = "user_pseudo_id") -> DataFrame:
    """The users of each ``keys`` group of ``rows`` as bitmaps: (keys, chunk, users).

    A group of rows without a user has no bitmap.  Repeated users are dropped before
    the shuffle, so a very active one costs a row per task and group.
    """
    seen = rows.select(*keys, F.col(user).alias("user")).filter(F.col("user").isNotNull()).distinct()
    numbered = seen.join(numbers, "user").select(*keys, "user_no")
    return numbered.groupBy(*keys, F.expr("bitmap_bucket_number(user_no)").alias("chunk")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(user_no))").alias("users")
    )


def distinct_users(bitmaps: DataFrame, keys: list[str], name: str = "distinct_users") -> DataFrame:
    """Distinct users of each ``keys`` group of stored bitmaps."""
    merged = bitmaps.groupBy(*keys, "chunk").agg(F.expr("bitmap_or_agg(users)").alias("users"))
    return merged.groupBy(*keys).agg(F.sum(F.expr("bitmap_count(users)")).alias(name))
