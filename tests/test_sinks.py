"""CSV exports: names, routing, headers, read-back equality."""

import os
import tempfile

from shopscope import config as C
from shopscope.operators import segments as S
from shopscope.plans import jobs
from shopscope.sinks.csv_export import export_name, write_segment_extracts
from shopscope.sources.fixtures import FixtureInputs

from .conftest import SF_SMALL


def _read(spark, path):
    return spark.read.option("header", True).csv(path)


def test_export_name():
    assert export_name("cat_curve", C.FIXTURE_AS_OF) == "cat_curve_30-06-2001.csv"


def test_routed_segment_files(spark):
    root = tempfile.mkdtemp(prefix="shopscope-out-", dir="/tmp")
    inputs = FixtureInputs(spark, SF_SMALL)
    scv = jobs.build_scv(inputs, C.FIXTURE_AS_OF)
    paths = write_segment_extracts(scv, root, C.FIXTURE_AS_OF, layout="routed")
    assert len(paths) == 10
    long = S.segment_extracts(scv)
    for base, _column, folder in C.SEGMENT_ROUTING:
        path = f"{root}/{folder}/{base}_30-06-2001.csv"
        assert os.path.isdir(path)
        df = _read(spark, path)
        expected = long.filter(long.segment_name == base)
        assert df.count() == expected.count()
        if base == C.SUPRE_SEGMENT:
            assert df.columns == ["customer_id", "Segment", "email_address"]
        else:
            assert df.columns == ["customer_id", "Segment"]
            got = sorted((int(r.customer_id), r.Segment) for r in df.collect())
            assert got == sorted((r.customer_id, r.Segment) for r in expected.collect())


def test_partitioned_segment_files(spark):
    root = tempfile.mkdtemp(prefix="shopscope-out-", dir="/tmp")
    inputs = FixtureInputs(spark, SF_SMALL)
    scv = jobs.build_scv(inputs, C.FIXTURE_AS_OF)
    seg_path, supre_path = write_segment_extracts(scv, root, C.FIXTURE_AS_OF, layout="partitioned")
    back = _read(spark, seg_path)
    long = S.segment_extracts(scv)
    assert back.count() == long.filter(long.segment_name != C.SUPRE_SEGMENT).count()
    assert _read(spark, supre_path).count() == S.supre_extract(scv).count()


def test_report_jobs_write_one_named_file(spark):
    root = tempfile.mkdtemp(prefix="shopscope-out-", dir="/tmp")
    inputs = FixtureInputs(spark, SF_SMALL)
    path = jobs.run_age_profile(inputs, C.FIXTURE_AS_OF, root)
    assert path.endswith("/ageProfiling_30-06-2001.csv")
    assert any(f.startswith("part-") for f in os.listdir(path))
    assert _read(spark, path).count() == jobs.build_age_profile(inputs, C.FIXTURE_AS_OF).count()
    item_path = jobs.run_age_profile_item(inputs, C.FIXTURE_AS_OF, root)
    assert item_path.endswith("/ageProfileItem/ageProfilingItem_30-06-2001.csv")
    report = jobs.run_mobile_report(inputs, f"{root}/mobile")
    assert _read(spark, report).count() > 0


def test_reusable_without_checkpoint_folder_persists(spark, monkeypatch):
    from pyspark import StorageLevel

    from shopscope import session

    checkpointed = session.reusable(spark.range(5))  # the test session names a checkpoint folder
    assert checkpointed.count() == 5 and checkpointed.storageLevel == StorageLevel.NONE
    monkeypatch.setattr(session, "checkpoint_dir", lambda _spark: None)
    persisted = session.reusable(spark.range(10))
    assert persisted.storageLevel == StorageLevel.MEMORY_AND_DISK
    assert persisted.count() == 10
    persisted.unpersist()


def _file_text(path):
    import glob

    return "".join(open(f, newline="").read() for f in sorted(glob.glob(f"{path}/part-*.csv")))


def test_csv_bytes(spark, tmp_path):
    from shopscope.sinks.csv_export import write_csv

    rows = [(1, '6" heel', 12345678.5), (2, " outer blanks ", 1e7), (3, "a,b", 0.5), (4, None, None), (5, "", -98765432.25), (6, "x", 100.0)]
    df = spark.createDataFrame(rows, "id int, text string, sales double")
    write_csv(df.orderBy("id"), f"{tmp_path}/out", single_file=True)
    assert _file_text(f"{tmp_path}/out") == (
        "id,text,sales\n"
        '1,"6"" heel",12345678.5\n'
        "2, outer blanks ,10000000.0\n"
        '3,"a,b",0.5\n'
        "4,,\n"
        "5,,-98765432.25\n"
        "6,x,100.0\n"
    )


def test_partitioned_layout_computes_the_view_once(spark, tmp_path):
    """The view counts its evaluated rows: both writes read one stored copy."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from shopscope import config as C
    from shopscope.operators.segments import SCV_COLUMNS
    from shopscope.sinks.csv_export import write_segment_extracts

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    base = spark.createDataFrame([(i,) for i in range(20)], "customer_id int")
    view = base.select("customer_id", *[counted(F.lit("Pure")).alias(c) for c in SCV_COLUMNS[1:2]], *[F.lit("Pure").alias(c) for c in SCV_COLUMNS[2:]])
    write_segment_extracts(view, f"{tmp_path}/x", datetime(2001, 6, 30), "partitioned")
    assert seen.value == 20 and C.SEGMENT_ROUTING
