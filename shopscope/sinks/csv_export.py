"""CSV exports: header row, no index, blanks for NULL and empty text.

A Spark output is a directory of part files written by the tasks in
parallel under the job commit protocol (a retried task or a lost executor
does not leave partial output behind).  ``path`` can be any Hadoop
file-system URI (local, HDFS, object store), which replaces the
reference's FTP / SFTP / object-store upload clients.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators.segments import segment_extracts, supre_extract
from ..session import reusable
from .one_file import csv_lines, header_line, move_all, number_text, write_file


def export_name(base: str, as_of: datetime) -> str:
    """``<base>_dd-mm-yyyy.csv`` for the run date."""
    return f"{base}_{as_of.strftime(C.EXPORT_DATE_FORMAT)}.csv"


def plain_doubles(df: DataFrame) -> DataFrame:
    """``df`` with amounts as text in the form of :func:`~shopscope.sinks.one_file.number_text`."""
    out = df
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            out = out.withColumn(f.name, number_text(value))
        elif isinstance(f.dataType, T.FloatType):
            out = out.withColumn(f.name, number_text(value.cast("string").cast("double")))
    return out


def write_csv(df: DataFrame, path: str, single_file: bool = False, partition_by: list[str] | None = None) -> None:
    """Write ``df`` as CSV with a header.

    Fields are quoted where needed with doubled inner quotes, blanks at
    either end stay, and amounts are written in plain notation.

    ``single_file`` merges the output into one part file (one task); use it
    only for small reports such as the daily aggregates.
    """
    if single_file:
        df = df.coalesce(1)
    writer = (
        plain_doubles(df)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .option("nullValue", "")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_segment_extracts(scv_df: DataFrame, root: str, as_of: datetime, layout: str = "routed") -> list[str]:
    """Write the ten segment files of the customer view; returns the paths.

    ``routed``: one directory per segment, ``<root>/<folder>/<base>_<date>.csv``,
    matching the destination folders of the original exports.  The view is
    made reusable first (checkpoint in the cluster's checkpoint folder, or
    persisted) so the ten writes read it instead of recomputing it.

    ``partitioned``: one write makes ``<root>/segments_<date>/segment_name=<base>/``
    for the nine plain segments, another ``<root>/<supre base>_<date>.csv``
    (which carries the e-mail address as well).  Rows are dealt by segment
    and a few salts first, so a segment gets ``SEGMENT_FILES`` files and not
    one per task.

    ``files``: the folders and names of ``routed``, each a single CSV file
    ordered by customer (:func:`~shopscope.sinks.one_file.write_file`).

    ``one_pass``: the folders and names of ``routed``, written by one job that reads
    the view once and keeps no copy of it, and put in place together.

    In every layout the view is computed once and released.
    """
    if layout not in ("routed", "partitioned", "files", "one_pass"):
        raise ValueError(f"unknown layout {layout!r}")
    if layout == "one_pass":
        return _write_one_pass(scv_df, root, as_of)
    view = reusable(scv_df)
    try:
        if layout == "partitioned":
            return _write_partitioned(view, root, as_of)
        return _write_routed(view, root, as_of, one_file=layout == "files")
    finally:
        view.unpersist()


#: Files of one segment in the partitioned layout.
SEGMENT_FILES = 16


def _write_partitioned(view: DataFrame, root: str, as_of: datetime) -> list[str]:
    long = segment_extracts(view).filter(F.col("segment_name") != C.SUPRE_SEGMENT)
    salt = F.pmod(F.xxhash64("customer_id"), F.lit(SEGMENT_FILES))
    path = f"{root}/segments_{as_of.strftime(C.EXPORT_DATE_FORMAT)}"
    write_csv(long.repartition("segment_name", salt), path, partition_by=["segment_name"])
    supre = f"{root}/{export_name(C.SUPRE_SEGMENT, as_of)}"
    write_csv(supre_extract(view), supre)
    return [path, supre]


def _write_one_pass(scv_df: DataFrame, root: str, as_of: datetime, files: int = SEGMENT_FILES) -> list[str]:
    """All ten segments by one job: rows become finished lines, dealt by segment and salt.

    Two column sets cannot share a columnar writer, but their lines can.  Each segment
    has ``files`` files, each with its header, also where it holds no row, and ordered
    by customer.  The job commits into a hidden folder; then the ten folders are moved
    to their places, and back again if one of the moves fails.
    """
    bases = [base for base, _, _ in C.SEGMENT_ROUTING]
    renamed = scv_df.select("customer_id", "email_address", *[F.col(c).alias(b) for b, c, _ in C.SEGMENT_ROUTING])
    long = renamed.unpivot(["customer_id", "email_address"], bases, "segment_name", "Segment")
    long = long.filter(~F.col("Segment").eqNullSafe(F.lit("")))
    plain, mailed = long.select("customer_id", "Segment"), long.select("customer_id", "Segment", "email_address")
    place = F.element_at(F.create_map(*[x for i, b in enumerate(bases) for x in (F.lit(b), F.lit(i))]), F.col("segment_name"))
    lines = long.select(
        "segment_name",
        (place * files + F.pmod(F.xxhash64("customer_id"), F.lit(files))).cast("int").alias("file"),
        F.lit(1).alias("head"),
        F.col("customer_id").alias("k"),
        F.when(F.col("segment_name") == C.SUPRE_SEGMENT, csv_lines(mailed)).otherwise(csv_lines(plain)).alias("value"),
    )
    spark, n = scv_df.sparkSession, len(bases) * files
    number = F.col("id").cast("int")
    named = F.element_at(F.array(*[F.lit(b) for b in bases]), F.floor(number / files).cast("int") + 1)
    headers = spark.range(n).select(
        named.alias("segment_name"),
        number.alias("file"),
        F.lit(0).alias("head"),
        F.lit(None).cast(lines.schema["k"].dataType).alias("k"),
        F.when(named == C.SUPRE_SEGMENT, F.lit(header_line(mailed))).otherwise(F.lit(header_line(plain))).alias("value"),
    )
    dealt = headers.unionByName(lines).repartitionById(n, F.col("file"))
    ordered = dealt.sortWithinPartitions("segment_name", "head", F.col("k").asc_nulls_first(), "value")
    staged = f"{root}/.segments-{uuid.uuid4().hex}"
    moves = [(f"{staged}/segment_name={b}", f"{root}/{folder}/{export_name(b, as_of)}") for b, _, folder in C.SEGMENT_ROUTING]
    write = ordered.select("segment_name", "value").write.option("lineSep", "\n")
    move_all(spark, staged, moves, lambda: write.partitionBy("segment_name").text(staged))
    return [target for _, target in moves]


def _write_routed(view: DataFrame, root: str, as_of: datetime, one_file: bool = False) -> list[str]:
    paths: list[str] = []
    for base, column, folder in C.SEGMENT_ROUTING:
        if base == C.SUPRE_SEGMENT:
            out = supre_extract(view)
        else:
            out = view.filter(~F.col(column).eqNullSafe(F.lit(""))).select(
                "customer_id", F.col(column).alias("Segment")
            )
        path = f"{root}/{folder}/{export_name(base, as_of)}"
        if one_file:
            write_file(out, path, ["customer_id"])
        else:
            write_csv(out, path)
        paths.append(path)
    return paths
