"""A full pipeline run: build every model, write the marts, check quality.

* The two reused intermediates are written once to the shared storage root
  and read back (reliable, lineage-cutting; a lost executor never forces a
  recompute from the raw scans).
* Every table is a folder of versions (``sources/versions.py``): a rebuild
  into the same ``out_dir`` shows readers the old table until the new one is
  whole; ``RunResult.tables`` names the versions of this run.
* Core marts are written as tables, and the reports read those tables, as in
  the warehouse layout.  Facts are partitioned by year so date-range reads
  prune directories.
* The data-quality checks run last, over the written tables, and are written
  as a table of results (a failing check is a row, not an exception).
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from tillbook.plans.graph import CORE, REPORTS, Project
from tillbook.session import run_folder
from tillbook.sources.versions import prune, publish

PARTITION_COLUMNS = {"fct_orders": ["order_year"], "fct_revenue": ["paid_year"]}


@dataclass
class RunResult:
    root: str
    tables: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def build_all(
    project: Project, out_dir: str | None = None, with_checks: bool = True, parallel_models: int = 4
) -> RunResult:
    """Build and write every model, layer by layer.

    Models of one layer are independent once the previous layer is written,
    so their writes run as concurrent Spark jobs (``parallel_models``, as
    many as the warehouse runner's threads): one job's single-task scans and
    stage gaps are filled by another's tasks.  DataFrames are built on the
    calling thread; worker threads only run the write actions."""
    spark = project.spark
    root = out_dir or run_folder(spark, "run")
    result = RunResult(root=root)

    def layer(names: tuple[str, ...], folder: str = "marts") -> None:
        frames = {name: project.table(name) for name in names}

        def write(name: str) -> tuple[str, str, float]:
            start = time.perf_counter()
            path = publish(frames[name], f"{root}/{folder}/{name}", PARTITION_COLUMNS.get(name))
            prune(spark, f"{root}/{folder}/{name}")
            return name, path, time.perf_counter() - start

        with ThreadPoolExecutor(max_workers=max(1, parallel_models)) as pool:
            for name, path, seconds in pool.map(write, names):
                result.seconds[name] = seconds
                result.tables[name] = path
        for name in names:
            project.use(name, spark.read.parquet(result.tables[name]))

    # the customer roll-up reads the order roll-up, so they are two layers
    layer(("int_orders_enriched",), folder="intermediate")
    layer(("int_customer_lifetime",), folder="intermediate")
    layer(CORE)
    layer(REPORTS)
    if with_checks:
        from tillbook.operators.quality import run_checks

        start = time.perf_counter()
        path = publish(run_checks(project), f"{root}/checks/dq_summary")
        prune(spark, f"{root}/checks/dq_summary")
        result.seconds["dq_summary"] = time.perf_counter() - start
        result.tables["dq_summary"] = path
    return result
