"""One CSV file under the expected name, written in parallel.

The readers of these exports fetch ``cat_curve_30-06-2001.csv``: a file, with one
header, in the order of the report, with the text a data frame library writes.

1. Every row is formatted as its CSV line in the tasks of the report, with built-in
   functions only (:func:`csv_lines`).
2. The finished lines are handed to one task, which sorts them by the report's order
   and writes them under the header.  A file has one writer; the task does nothing
   else, sorts with spilling and never holds the file.
3. Spark's commit leaves one part file in a hidden folder beside the target.  It is
   renamed to the target in one step, and the folder removed, also after an error: the
   target is either the old file or the whole new one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number_text(value: Column) -> Column:
    """A DOUBLE as its shortest decimal text: plain from 0.0001 up to 1e16, else with an exponent of two digits or more.

    The engine's own text changes to an exponent at 0.001 and 1e7 already and has
    another form for it; its digits are taken as they are.  NaN is blank.
    """
    text = value.cast("string")
    shape = r"^(-?)([0-9])\.([0-9]+)E(-?[0-9]+)$"
    part = lambda k: F.regexp_extract(text, shape, k)
    sign, exponent = part(1), part(4).cast("int")
    fraction = F.when(part(3) == "0", F.lit("")).otherwise(part(3))
    digits = F.concat(part(2), fraction)
    n = F.length(digits)
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    whole = F.concat(sign, digits, F.repeat(F.lit("0"), exponent + 1 - n), F.lit(".0"))
    mixed = F.concat(sign, F.substring(digits, F.lit(1), exponent + 1), F.lit("."), F.substring(digits, exponent + 2, n))
    point = F.when(fraction == "", F.lit("")).otherwise(F.concat(F.lit("."), fraction))
    power = F.concat(F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.abs(exponent).cast("string"), 2, "0"))
    far = F.concat(sign, part(2), point, F.when(F.abs(exponent) < 100, power).otherwise(
        F.concat(F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")), F.abs(exponent).cast("string"))
    ))
    return (
        F.when(F.isnan(value), F.lit(None))
        .when(text == "Infinity", F.lit("inf"))
        .when(text == "-Infinity", F.lit("-inf"))
        .when(part(2) == "", text)
        .when(exponent.between(-4, -1), small)
        .when(exponent.between(0, 15) & (n <= exponent + 1), whole)
        .when(exponent.between(0, 15), mixed)
        .otherwise(far)
    )


def _field(value: Column, kind: T.DataType) -> Column:
    """A column as the text of its CSV field; NULL is blank."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        raise ValueError(f"a CSV field cannot hold {kind.simpleString()}")
    if isinstance(kind, T.DoubleType):
        text = number_text(value)
    elif isinstance(kind, T.FloatType):
        text = number_text(value.cast("string").cast("double"))
    elif isinstance(kind, T.BooleanType):
        text = F.when(value, F.lit("True")).when(~value, F.lit("False"))
    else:
        text = value.cast("string")
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(text.rlike('[",\r\n]'), quoted).otherwise(text), F.lit(""))


def csv_lines(df: DataFrame) -> Column:
    """The CSV line of a row of ``df``; a line that would be empty is a quoted blank."""
    fields = [_field(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    line = F.concat_ws(",", *fields)
    return F.when(line == "", F.lit('""')).otherwise(line)


def header_line(df: DataFrame) -> str:
    """The names of ``df`` as a CSV line."""
    cells = ['"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\r\n') else c for c in df.columns]
    return ",".join(cells)


def write_file(df: DataFrame, path: str, order_by: list[str] | None = None) -> str:
    """Write ``df`` as the CSV file ``path`` (any Hadoop file system); returns ``path``.

    Rows are in the order of ``order_by`` (NULLs first) and, where that leaves ties, of
    their lines, so that equal results give equal files.  An existing file is replaced.
    """
    spark = df.sparkSession
    root, _, name = path.rpartition("/")
    folder = f"{root}/.{name}.{uuid.uuid4().hex}"
    keys = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order_by or [])]
    lines = df.select(F.lit(1).alias("head"), *keys, csv_lines(df).alias("value"))
    first = spark.range(1).select(F.lit(0).alias("head"), *[F.lit(None).cast(lines.schema[f"k{i}"].dataType).alias(f"k{i}") for i in range(len(keys))], F.lit(header_line(df)).alias("value"))
    order = ["head", *[F.col(f"k{i}").asc_nulls_first() for i in range(len(keys))], "value"]
    # repartition(1) is a shuffle: whatever makes the lines keeps its own tasks.
    ready = first.unionByName(lines).repartition(1).sortWithinPartitions(*order).select("value")
    try:
        ready.write.option("lineSep", "\n").text(folder)
        _move_part(spark, folder, path)
    finally:
        files, where = _files(spark, folder)
        files.delete(where, True)
    return path


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def move_all(spark: SparkSession, staged: str, moves: list[tuple[str, str]], write: Callable[[], None]) -> None:
    """Run ``write``, which fills the folder ``staged``, then put every (made, target) of ``moves`` in place.

    Targets that exist are kept aside until all are moved; a failed move puts them back
    and removes what had been moved.  ``staged`` is removed in any case.
    """
    files, where = _files(spark, staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    done: list[tuple] = []
    try:
        write()
        for i, (made, target) in enumerate(moves):
            place, aside = path(target), path(f"{staged}/_aside/{i}")
            files.mkdirs(place.getParent())
            files.mkdirs(aside.getParent())
            old = files.exists(place)
            if old and not files.rename(place, aside):
                raise RuntimeError(f"{target} could not be set aside")
            done.append((place, aside if old else None))
            if not files.rename(path(made), place):
                raise RuntimeError(f"{made} could not be renamed to {target}")
    except Exception:
        for place, aside in reversed(done):
            files.delete(place, True)
            if aside is not None:
                files.rename(aside, place)
        raise
    finally:
        files.delete(where, True)


def _move_part(spark: SparkSession, folder: str, path: str) -> None:
    """Put the one part file of ``folder`` in the place of ``path``."""
    files, where = _files(spark, folder)
    parts = [s.getPath() for s in files.listStatus(where) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"{folder} holds {len(parts)} part files")
    _, target = _files(spark, path)
    if files.exists(target):
        files.delete(target, True)  # a folder of an earlier layout as well
    if not files.rename(parts[0], target):
        raise RuntimeError(f"{parts[0]} could not be renamed to {path}")
