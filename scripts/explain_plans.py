"""Write PLANS.md: the final (adaptive) physical plan shape of each headline query.

Each query is executed once (``noop`` sink) so AQE's runtime decisions —
broadcast conversions, coalesced or skew-split partitions — are in the plan.
Only the operators that matter for scale are kept: exchanges, joins,
aggregates, windows, sorts, scans with their read schema and pushed filters.

Usage: python scripts/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from tillbook.queries import registered  # noqa: E402
from tillbook.session import get_session  # noqa: E402

KEEP = re.compile(
    r"(Exchange|Join|Aggregate|Window|TakeOrdered|Sort |Expand|Union|Scan parquet|Scan ExistingRDD|AQEShuffleRead)"
)


def shape(df) -> list[str]:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    lines = []
    for line in final.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            line = re.sub(r"Location: [^,]*, ", "", line)
            lines.append(line.rstrip()[:220])
    return lines


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session(shuffle_partitions=8)
    # Show the shape that runs when no join side fits in memory (the 100 TB
    # case): with the default 32 MB threshold AQE would turn every join
    # against an aggregated side into a broadcast join at this small scale.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    queries = registered()
    print(f"# Final physical plans at {os.path.basename(sf_dir)} (local[8], AQE on, size-based broadcast off)\n")
    print(
        "Generated by `python scripts/explain_plans.py`; operators that matter for scale only. Size-based\n"
        "broadcasting is switched off to show the shape that runs when no join side fits in memory; with\n"
        "the default 32 MB threshold AQE measures the aggregated sides at this scale and broadcasts them.\n"
        "Remaining `BroadcastExchange` nodes are the bounded ones (the daily batch and its keys).\n"
    )
    for name in HEADLINE:
        print(f"## {name}\n\n```")
        print("\n".join(shape(queries[name](spark, sf_dir))))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
