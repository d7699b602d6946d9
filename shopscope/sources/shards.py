"""Event tables kept as one shard per day: ``events_20240131``, ``events_20240201``, ...

:func:`read_shards` resolves a name pattern to the shards that exist, in a
database of the catalog or as folders under a root, and unions those of a range
of days.

* The range is applied to the names, before any shard is opened: a shard outside
  takes no part in the plan.
* Each shard's day is a literal column, so a later filter on it
  (``event_date >= '20240131'``) folds to true or false per shard and the
  optimiser drops whole shards from the union.
* Shards are written over years and their columns drift.  Each is brought to the
  logical schema by name, into nested structures: missing columns and fields become
  NULL, others are dropped, narrower numbers are widened, a number where text is
  expected is written out.  Anything else is an error that names shard and column.
  A column whose type fits is passed on untouched, so nested fields that a report
  does not use are still pruned from the scan.
"""

from __future__ import annotations

import re
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import APP_EVENTS

_SUFFIX = re.compile(r"[0-9]{8}")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBER = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


def _days(names: list[str], prefix: str) -> dict[str, str]:
    """Day suffix -> name, of the names that are the prefix and eight digits."""
    found = {}
    for name in names:
        suffix = name[len(prefix) :]
        if name.startswith(prefix) and _SUFFIX.fullmatch(suffix):
            found[suffix] = name
    return dict(sorted(found.items()))


def table_shards(spark: SparkSession, pattern: str) -> dict[str, str]:
    """Day -> table, for a pattern like ``analytics.events_*``."""
    database, _, name = pattern.rpartition(".")
    prefix = name.removesuffix("*")
    listed = spark.catalog.listTables(database or None, f"{prefix}*")
    return {day: f"{database}.{n}" if database else n for day, n in _days([t.name for t in listed], prefix).items()}


def folder_shards(spark: SparkSession, pattern: str) -> dict[str, str]:
    """Day -> folder, for a pattern like ``s3a://bucket/analytics/events_*`` (any Hadoop file system)."""
    root, _, name = pattern.rpartition("/")
    prefix = name.removesuffix("*")
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(root)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = [s.getPath().getName() for s in listed if s.isDirectory()]
    return {day: f"{root}/{n}" for day, n in _days(names, prefix).items()}


def in_range(shards: dict[str, str], first: date | None = None, last: date | None = None) -> dict[str, str]:
    """The shards of the days from ``first`` to ``last``, both included."""
    low = first.strftime("%Y%m%d") if first else ""
    high = last.strftime("%Y%m%d") if last else "99999999"
    return {day: name for day, name in shards.items() if low <= day <= high}


def aligned(value: Column, have: T.DataType, want: T.DataType, where: str) -> Column:
    """``value`` of type ``have`` as type ``want``, by field name; raises ``ValueError`` naming ``where`` if it cannot be."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        known = {f.name: f.dataType for f in have.fields}
        fields = [
            aligned(value[f.name], known[f.name], f.dataType, f"{where}.{f.name}").alias(f.name)
            if f.name in known
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        if _same(have.elementType, want.elementType):
            return value
        return F.transform(value, lambda x: aligned(x, have.elementType, want.elementType, f"{where}[]"))
    widens = (
        isinstance(have, T.NullType)
        or (isinstance(want, T.StringType) and isinstance(have, (*_WHOLE, T.StringType, T.VarcharType, T.CharType)))
        or (isinstance(want, _WHOLE) and isinstance(have, _WHOLE) and _WHOLE.index(type(have)) <= _WHOLE.index(type(want)))
        or (isinstance(want, T.DoubleType) and isinstance(have, _NUMBER))
        or (isinstance(want, T.DecimalType) and isinstance(have, (*_WHOLE, T.DecimalType)))
    )
    if not widens:
        raise ValueError(f"{where}: {have.simpleString()} cannot be read as {want.simpleString()}")
    return value.cast(want)


def _same(have: T.DataType, want: T.DataType) -> bool:
    """Equal but for nullability."""
    return have.simpleString() == want.simpleString()


def align(df: DataFrame, schema: T.StructType, shard: str) -> DataFrame:
    """``df`` with exactly the columns of ``schema``."""
    known = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        if f.name not in known:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif _same(known[f.name], f.dataType):
            columns.append(F.col(f"`{f.name}`"))
        else:
            columns.append(aligned(F.col(f"`{f.name}`"), known[f.name], f.dataType, f"{shard}: {f.name}").alias(f.name))
    return df.select(*columns)


def read_shards(
    spark: SparkSession,
    pattern: str,
    first: date | None = None,
    last: date | None = None,
    schema: T.StructType = APP_EVENTS,
    day_column: str = "event_date",
) -> DataFrame:
    """All shards matching ``pattern`` (a table name, or a path with a ``/``) from ``first`` to ``last``.

    ``day_column`` is the day in the shard's name, as ``yyyyMMdd`` text: shards are
    filed by it.  Without any shard the result is empty.
    """
    if not pattern.endswith("*"):
        raise ValueError(f"{pattern!r} is not a pattern like events_*")
    folders = "/" in pattern
    found = in_range(folder_shards(spark, pattern) if folders else table_shards(spark, pattern), first, last)
    if not found:
        return spark.createDataFrame([], schema)
    parts = []
    for day, name in found.items():
        shard = spark.read.parquet(name) if folders else spark.table(name)
        parts.append(align(shard, schema, name).withColumn(day_column, F.lit(day)).select(*schema.fieldNames()))
    return reduce(DataFrame.unionAll, parts)
