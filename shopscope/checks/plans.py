"""Plan report: shuffles, broadcasts and joins of every registered query.

``python -m shopscope.checks.plans [sf_dir] > PLANS.md`` prints one table row
per query, read from the formatted physical plan with estimate-based
broadcast turned off (as at scale, where only size-checked hints and
AQE's measured broadcasts remain).  The counts include the fixture mapping
that derives the retail inputs from the test tables (e.g. the sale fact is
lineitem joined to orders and customer).
"""

from __future__ import annotations

import contextlib
import io
import re
import sys


def plan_text(df) -> str:
    """The formatted physical plan, as printed by ``df.explain(mode="formatted")``."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


def plan_stats(text: str) -> dict[str, int]:
    tree = text.split("\n\n")[0]
    return {
        "shuffles": len(re.findall(r"(?<!Broadcast)Exchange \(", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange \(", tree)),
        "sort-merge joins": len(re.findall(r"SortMergeJoin", tree)),
        "broadcast joins": len(re.findall(r"BroadcastHashJoin", tree)),
        "windows": len(re.findall(r"\bWindow \(", tree)),
        "window group limits": len(re.findall(r"WindowGroupLimit \(", tree)),
        "generators": len(re.findall(r"\bGenerate \(", tree)),
        "scans": len(re.findall(r"Scan parquet", tree)),
        "scans with pushed filters": len(re.findall(r"PushedFilters: \[[^\]]", text)),
    }


def main(argv: list[str]) -> None:
    from ..plans.queries import query_functions as queries
    from ..session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4]", shuffle_partitions=8)
    rows = {name: plan_stats(plan_text(build(spark, sf_dir))) for name, build in queries().items()}
    cols = list(next(iter(rows.values())))
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for name, stats in rows.items():
        print(f"| `{name}` | " + " | ".join(str(stats[c]) for c in cols) + " |")


if __name__ == "__main__":
    main(sys.argv)
