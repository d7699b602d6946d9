"""End-to-end jobs: build a report and write its exports.

Each job takes the logical inputs (any object with the attributes of
:class:`~shopscope.sources.inputs.RetailInputs`), an explicit run time
``as_of`` and an output root (any Hadoop file-system URI).  Scheduling is
left to the platform; a daily run passes that day's run time.

Command line, over catalog tables (``input=table`` pairs), a folder with one
Parquet table per input, or the test fixture::

    python -m shopscope.plans.jobs scv --tables fact_sales=rpt.fact_sale,... --out URI --as-of 2024-05-01T10:46
    python -m shopscope.plans.jobs age_profile --parquet-root URI --out URI --as-of 2024-05-01T10:46
    python -m shopscope.plans.jobs scv --sf-dir /root/testdata/sf0.01 --out /tmp/out [--layout routed|partitioned|files|one_pass]
"""

from __future__ import annotations

import argparse
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame

from .. import config as C
from ..operators import age_profile as AP
from ..operators import loyalty as L
from ..operators import mobile as M
from ..operators import segments as S
from ..sinks.csv_export import export_name, write_csv, write_segment_extracts
from ..sinks.one_file import write_file


def _loyalty_args(inputs, as_of: datetime) -> tuple:
    return (
        inputs.loyalty_customer,
        inputs.loyalty_member,
        inputs.crm_customer,
        inputs.cust_store,
        inputs.dim_store,
        inputs.location,
        as_of,
    )


def plan_in_parallel(*builders):
    """Build independent plans in threads and return them in order.

    Building a plan runs its broadcast size checks (small Spark jobs); Spark
    runs jobs submitted from separate threads concurrently, so independent
    inputs of one report do not wait for each other's checks.
    """
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        futures = [pool.submit(build) for build in builders]
        return [f.result() for f in futures]


def build_scv(inputs, as_of: datetime) -> DataFrame:
    customers, summary, engaged = plan_in_parallel(
        lambda: L.scv_customers(*_loyalty_args(inputs, as_of)),
        lambda: S.fact_summary(inputs.fact_sales, inputs.dim_item, as_of),
        lambda: S.engagement(inputs.opens, inputs.clicks, S.sports_campaigns(inputs.sendjobs)),
    )
    return S.scv(customers, summary, engaged, email_keys=S.customer_email_keys(inputs.crm_customer))


def run_scv(inputs, as_of: datetime, out_root: str, layout: str = "routed") -> list[str]:
    """Customer view and its ten segment extracts."""
    return write_segment_extracts(build_scv(inputs, as_of), out_root, as_of, layout)


def build_age_profile(inputs, as_of: datetime) -> DataFrame:
    perks, sales = plan_in_parallel(
        lambda: L.perks_snapshot(*_loyalty_args(inputs, as_of)),
        lambda: AP.age_profile_sales(inputs.fact_sales, inputs.dim_item, as_of),
    )
    return AP.age_profile(perks, sales)


def run_age_profile(inputs, as_of: datetime, out_root: str, one_file: bool = False) -> str:
    """Category age profile: ``<root>/ageProfiling_<date>.csv``.

    The report is sorted by its keys and written by many tasks (range
    partitioned, so the part files are in key order); its size grows with
    the number of categories and days, so it is not funnelled into one task.
    ``one_file`` writes a single file of that name instead.
    """
    path = f"{out_root}/{export_name(C.AGE_PROFILE_FILE, as_of)}"
    if one_file:
        return write_file(build_age_profile(inputs, as_of), path, AP.PROFILE_KEYS)
    report = build_age_profile(inputs, as_of).orderBy(*AP.PROFILE_KEYS)
    write_csv(report, path)
    return path


def build_age_profile_item(inputs, as_of: datetime) -> DataFrame:
    perks, sales = plan_in_parallel(
        lambda: L.perks_snapshot(*_loyalty_args(inputs, as_of)),
        lambda: AP.age_profile_item_sales(
            inputs.fact_sales, inputs.dim_item, inputs.date_dimension, as_of, AP.REPORT_ITEM_KEYS
        ),
    )
    return AP.age_profile_item(perks, sales)


def run_age_profile_item(inputs, as_of: datetime, out_root: str, one_file: bool = False) -> str:
    """Item age profile: ``<root>/ageProfileItem/ageProfilingItem_<date>.csv`` (sorted part files, or one file)."""
    path = f"{out_root}/{C.AGE_PROFILE_ITEM_FOLDER}/{export_name(C.AGE_PROFILE_ITEM_FILE, as_of)}"
    if one_file:
        return write_file(build_age_profile_item(inputs, as_of), path, AP.PROFILE_ITEM_KEYS)
    report = build_age_profile_item(inputs, as_of).orderBy(*AP.PROFILE_ITEM_KEYS)
    write_csv(report, path)
    return path


def run_mobile_report(
    inputs, out_path: str, first_day=None, last_day=None, daily: DataFrame | None = None, one_file: bool = False
) -> str:
    """Daily app report over the whole event history, sorted by country and day.

    One row per (day, country): small whatever the event volume, so it is
    written as a single file.  ``first_day`` / ``last_day`` restrict the
    reported days; ``daily`` may be the stored streaming counters; ``one_file``
    makes ``out_path`` the file itself and not the folder of its part.
    """
    report = M.mobile_report(inputs.app_events, inputs.date_dimension, daily, first_day, last_day)
    if one_file:
        return write_file(report, out_path, ["country", "event_date"])
    write_csv(report, out_path, single_file=True)
    return out_path


def main(argv: list[str] | None = None) -> None:
    from ..session import build_session
    from ..sources.fixtures import FixtureInputs
    from ..sources.inputs import RetailInputs

    parser = argparse.ArgumentParser(prog="shopscope.plans.jobs")
    parser.add_argument("job", choices=["scv", "age_profile", "age_profile_item", "mobile_report"])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--tables", help="comma-separated input=catalog table pairs, one for every input")
    source.add_argument("--parquet-root", help="folder with one Parquet table per input")
    source.add_argument("--sf-dir", help="test tables (the fixture)")
    parser.add_argument("--out", required=True)
    parser.add_argument("--as-of", default=None, help="run time (ISO); required but for the fixture")
    parser.add_argument("--layout", default="routed", choices=["routed", "partitioned", "files", "one_pass"])
    parser.add_argument("--one-file", action="store_true", help="reports as one CSV file of the expected name")
    parser.add_argument("--master", default=None)
    parser.add_argument("--first-day", default=None, help="mobile report: first reported day (YYYY-MM-DD)")
    parser.add_argument("--last-day", default=None, help="mobile report: last reported day (YYYY-MM-DD)")
    args = parser.parse_args(argv)
    if not args.as_of and not args.sf_dir:
        parser.error("--as-of is required")
    spark = build_session(args.master)
    if args.tables:
        inputs = RetailInputs.from_tables(spark, dict(pair.split("=", 1) for pair in args.tables.split(",")))
    elif args.parquet_root:
        inputs = RetailInputs.from_parquet(spark, args.parquet_root)
    else:
        inputs = FixtureInputs(spark, args.sf_dir)
    as_of = datetime.fromisoformat(args.as_of) if args.as_of else C.FIXTURE_AS_OF
    if args.job == "scv":
        print("\n".join(run_scv(inputs, as_of, args.out, args.layout)))
    elif args.job == "age_profile":
        print(run_age_profile(inputs, as_of, args.out, args.one_file))
    elif args.job == "age_profile_item":
        print(run_age_profile_item(inputs, as_of, args.out, args.one_file))
    else:
        day = lambda text: date.fromisoformat(text) if text else None
        out = f"{args.out}/mobile_report" + (".csv" if args.one_file else "")
        print(run_mobile_report(inputs, out, day(args.first_day), day(args.last_day), one_file=args.one_file))


if __name__ == "__main__":
    main()
