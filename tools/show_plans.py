"""Print condensed physical plans of the headline queries.

Usage: python tools/show_plans.py [sf_dir]

Broadcast joins are disabled (``autoBroadcastJoinThreshold=-1``) so the plans
show what happens when the small sides are too big to broadcast, i.e. the
100 TB case; only shuffles, joins, windows, aggregates, sorts, generators and
scans are kept, with scans reduced to their read schema and pushed filters.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskloom.operators import profiling, sampling  # noqa: E402
from riskloom.plans import catalog  # noqa: E402
from riskloom.session import local_session  # noqa: E402

KEEP = ("Exchange", "Join", "Window", "Aggregate", "Sort ", "Sort[", "Generate", "Scan", "Union", "Subquery")


def condensed(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        if "Scan" in line:
            cols = re.search(r"\[([^\]]*)\]", line)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            line = line[: line.index("Scan")] + "Scan parquet [" + (cols.group(1) if cols else "") + "]"
            if pushed and pushed.group(1):
                line += " PushedFilters: [" + pushed.group(1)[:120] + "]"
        out.append(line[:170])
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    stored = catalog.stored_features(spark, sf_dir)
    shows = {
        "features (raw text -> behaviour windows)": catalog.features(spark, sf_dir),
        "undersample (on the stored feature table)": sampling.undersample(stored),
        "correlation_matrix (on the stored feature table)": profiling.correlation_matrix(stored),
        "stats_by_class (exact medians, on the stored feature table)": profiling.stats_by_class(stored),
    }
    for title, df in shows.items():
        print(f"### {title}\n\n```\n{condensed(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
