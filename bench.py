"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no rows pulled to
the driver), twice: ``cold_queries`` is the first run of each query in the
session, ``queries`` the better of the two (steady state).  ``pipeline`` is
one complete run that writes the reused intermediates, the core marts, the
reports and the check results to the shared storage root.  Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillbook.plans.graph import Project  # noqa: E402
from tillbook.plans.pipeline import build_all  # noqa: E402
from tillbook.queries import registered  # noqa: E402
from tillbook.session import get_session  # noqa: E402

HEADLINE = [
    "int_orders_enriched",
    "int_customer_lifetime",
    "int_product_performance",
    "dim_customers",
    "dim_products",
    "fct_orders",
    "fct_revenue",
    "rpt_daily_revenue",
    "rpt_customer_ltv",
    "rpt_marketing_roi",
    "rpt_funnel",
    "rpt_executive_summary",
    "dq_summary",
    "batch_guard",
]


#: These write as they run, so their plans are not listed in PLANS.md.
WRITING = ["append_batch", "stream_append"]
TIMED = [*HEADLINE, *WRITING]

FAILED: dict[str, str] = {}


def run_query(spark, sf_dir: str, name: str) -> float:
    """Seconds to build and fully execute one query; failures are recorded, not raised."""
    start = time.perf_counter()
    try:
        registered()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    except Exception as exc:  # noqa: BLE001 - one failing query must not lose the other timings
        FAILED[name] = str(exc).splitlines()[0][:300]
        return float("nan")
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(cpus=cpus, shuffle_partitions=max(8, cpus))
    # warm the JVM (class loading, JIT of the scan/aggregate/join paths) outside the timings
    run_query(spark, sf_dir, "stg_orders")
    run_query(spark, sf_dir, "int_orders_enriched")

    # pass 1 is cold for every query (plan + code generation + first JIT of its
    # operators); pass 2 is the steady state of a long-lived executor JVM.
    cold = {name: run_query(spark, sf_dir, name) for name in TIMED}
    warm = {name: min(cold[name], run_query(spark, sf_dir, name)) for name in TIMED}
    start = time.perf_counter()
    try:
        build_all(Project.from_dir(spark, sf_dir))
        pipeline = time.perf_counter() - start
    except Exception as exc:  # noqa: BLE001
        FAILED["pipeline"] = str(exc).splitlines()[0][:300]
        pipeline = float("nan")
    ok = [name for name in TIMED if name not in FAILED]

    timings = {name: round(warm[name], 3) for name in ok}
    if "pipeline" not in FAILED:
        timings["pipeline"] = round(pipeline, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_warm",
                "value": round(sum(warm[name] for name in ok if name in HEADLINE), 3),
                "unit": "sec",
                "queries": timings,
                "cold_total": round(sum(cold[name] for name in ok if name in HEADLINE), 3),
                "cold_queries": {name: round(cold[name], 3) for name in ok},
                "failed": FAILED,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
