"""One named CSV file, byte for byte what a data frame library writes."""

import io
import math
import os
import random
import struct
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopscope import config as C
from shopscope.plans import jobs
from shopscope.sinks.one_file import number_text, write_file
from shopscope.sources.fixtures import FixtureInputs

from .conftest import SF_SMALL


def _folder():
    return tempfile.mkdtemp(prefix="shopscope-out-", dir="/tmp")


def _pandas_bytes(frame):
    out = io.StringIO()
    frame.to_csv(out, index=False, lineterminator="\n")
    return out.getvalue().encode()


def test_number_text_is_the_shortest(spark):
    rng = random.Random(2)
    values = [0.0005, -0.0001, 12345678.5, 0.0, -0.0, 1.0, 0.1, 1e-4, 9.99e-5, 1e-5, 123456789012345.6, 1e15, 1e16, 1.5e16]
    values += [1e7, 9999999.0, 12345678.0, 100000000.25, 1e100, -2.5e-7, 1e22, 0.001, 0.00123, 1.7976931348623157e308]
    values += [round(rng.uniform(-1, 1) * 10 ** rng.randint(-6, 9), rng.randint(0, 6)) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", number_text(F.col("v")).alias("t")).collect()
    assert [(r.v, r.t) for r in got if r.t != repr(r.v)] == []
    odd = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (None,)], "v double")
    assert [r[0] for r in odd.select(number_text(F.col("v"))).collect()] == [None, "inf", "-inf", None]
    bits = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(2000)]
    bits = [b for b in bits if math.isfinite(b)]
    back = spark.createDataFrame([(b,) for b in bits], "v double").select(number_text(F.col("v"))).collect()
    assert [float(r[0]) for r in back] == bits


def test_bytes_equal_the_data_frame_library(spark):
    rows = [
        (3, "plain", 0.0005, True), (1, 'with "quotes", commas', -0.0001, False), (2, " blanks at the ends ", 12345678.5, None),
        (4, "two\nlines", 0.0, True), (5, "carriage\rreturn", 1e16, True), (6, None, None, None), (7, "", 2.0, False), (None, "é😀\t", 1e-7, True),
    ]
    df = spark.createDataFrame(rows, "id long, `na,me` string, amount double, flag boolean").repartition(5)
    path = write_file(df, f"{_folder()}/report.csv", ["id"])
    assert os.path.isfile(path)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    frame = pd.DataFrame(ordered, columns=["id", "na,me", "amount", "flag"]).astype({"id": "Int64"})
    assert open(path, "rb").read() == _pandas_bytes(frame)


def test_decimals_dates_and_floats(spark):
    df = spark.sql("SELECT CAST(12.50 AS DECIMAL(9,2)) AS d, DATE'2024-02-29' AS day, CAST(0.1 AS FLOAT) AS f, 7Y AS n")
    path = write_file(df, f"{_folder()}/x.csv")
    assert open(path).read() == "d,day,f,n\n12.50,2024-02-29,0.1,7\n"
    with pytest.raises(ValueError):
        write_file(spark.sql("SELECT array(1) AS a"), f"{_folder()}/x.csv")


def test_one_empty_column_and_no_rows(spark):
    folder = _folder()
    df = spark.createDataFrame([("",), (None,), ("a",)], "c string")
    assert open(write_file(df, f"{folder}/a.csv")).read() == 'c\n""\n""\na\n'
    assert open(write_file(df.limit(0), f"{folder}/a.csv")).read() == "c\n"
    assert os.listdir(folder) == ["a.csv"] or sorted(os.listdir(folder)) == [".a.csv.crc", "a.csv"]


def test_a_failed_task_leaves_the_old_file_only(spark):
    folder = _folder()
    path = write_file(spark.range(3), f"{folder}/r.csv", ["id"])
    before = sorted(os.listdir(folder))
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_file(bad, path, ["id"])
    assert open(path).read() == "id\n0\n1\n2\n" and sorted(os.listdir(folder)) == before


def test_lines_are_made_in_parallel_and_merged_by_one_task(spark):
    df = spark.range(0, 50_000, 1, 6).select(F.xxhash64("id").alias("k"), "id")
    path = write_file(df, f"{_folder()}/big.csv", ["k"])
    got = pd.read_csv(path)
    assert len(got) == 50_000 and got["k"].is_monotonic_increasing


def test_jobs_write_named_files(spark):
    root, inputs = _folder(), FixtureInputs(spark, SF_SMALL)
    path = jobs.run_age_profile(inputs, C.FIXTURE_AS_OF, root, one_file=True)
    assert os.path.isfile(path) and path.endswith("/ageProfiling_30-06-2001.csv")
    want = jobs.build_age_profile(inputs, C.FIXTURE_AS_OF)
    assert len(pd.read_csv(path, keep_default_na=False)) == want.count()
    assert open(path).readline().strip() == ",".join(want.columns)
    item = jobs.run_age_profile_item(inputs, C.FIXTURE_AS_OF, root, one_file=True)
    assert os.path.isfile(item)
    assert os.path.isfile(jobs.run_mobile_report(inputs, f"{root}/mobile.csv", one_file=True))
    paths = jobs.run_scv(inputs, C.FIXTURE_AS_OF, root, layout="files")
    assert len(paths) == 10 and all(os.path.isfile(p) for p in paths)
    by_folder = jobs.run_scv(inputs, C.FIXTURE_AS_OF, _folder(), layout="routed")
    for one, many in zip(paths, by_folder):
        rows = spark.read.option("header", True).csv(many)
        assert sorted(open(one).read().splitlines()[1:]) == sorted(",".join(v or "" for v in r) for r in rows.collect())
