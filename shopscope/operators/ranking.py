"""``row_number()`` over groups that may be very large.

A window ``row_number() OVER (PARTITION BY g ORDER BY k1, k2, ...)`` sends
every row of a group to one task.  :func:`row_number_by` deals a group out by
its leading sort key instead, which is a property of the row and never of a
sample:

1. rows are ranked inside ``(g, k1)`` by the remaining keys;
2. the greatest rank of each ``(g, k1)`` is its number of rows; it is read off
   the ranked rows, whose shuffle both uses share, so the input is evaluated
   once.  A window over these numbers (one row per distinct leading key of a
   group) gives the rows of the group before ``k1``;
3. the two are added by a NULL-safe join on ``(g, k1)``.

There is one plan for groups of every size and no job at plan time.  The keys
must order the rows of a group totally, as for any deterministic
``row_number``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_number_by(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name = row_number() OVER (PARTITION BY group ORDER BY order)``, NULLs first."""
    lead, *rest = order
    keys = [F.col(c).asc_nulls_first() for c in (rest or [lead])]
    local = df.withColumn("_local", F.row_number().over(Window.partitionBy(group, lead).orderBy(*keys)))
    counts = local.groupBy(F.col(group).alias("_g"), F.col(lead).alias("_k")).agg(F.max("_local").alias("_rows"))
    earlier = Window.partitionBy("_g").orderBy(F.col("_k").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_g", "_k", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    on = local[group].eqNullSafe(offsets["_g"]) & local[lead].eqNullSafe(offsets["_k"])
    return (
        local.join(offsets, on)
        .withColumn(name, (F.col("_offset") + F.col("_local")).cast("int"))
        .drop("_local", "_offset", "_g", "_k")
    )
