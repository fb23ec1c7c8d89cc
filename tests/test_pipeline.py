"""Whole-pipeline run, seed round trip and plan shape."""

import re

import pytest

from tests.conftest import SF_SMALL
from tillbook.plans.graph import CORE, REPORTS, Project
from tillbook.plans.pipeline import build_all
from tillbook.queries import registered
from tillbook.session import run_folder
from tillbook.sources.seeds import load_seed, write_seed_csv
from tillbook.sources.tables import read_landed, read_raw_tables, read_source


def _rows(df):
    return sorted(map(lambda r: tuple(r.asDict().items()), df.collect()), key=str)


def test_build_all_matches_lazy_models(spark):
    result = build_all(Project.from_dir(spark, SF_SMALL))
    fresh = Project.from_dir(spark, SF_SMALL)
    for name in CORE + REPORTS:
        written = spark.read.parquet(result.tables[name])
        lazy = fresh.table(name).select(*written.columns)
        assert _rows(written) == _rows(lazy), name


def test_seed_csv_round_trip(spark):
    p = Project.from_dir(spark, SF_SMALL)
    root = run_folder(spark, "test-seeds")
    for table in ("raw_shipments", "raw_marketing_clicks", "raw_marketing_campaigns", "raw_payments"):
        write_seed_csv(p.table(table), f"{root}/csv/{table}")
        load_seed(spark, f"{root}/csv/{table}", table, f"{root}/raw")
    landed = read_raw_tables(spark, f"{root}/raw")
    for table, df in landed.items():
        assert _rows(df) == _rows(p.table(table)), table
    # empty CSV fields came back as NULL
    assert landed["raw_shipments"].where("delivered_at IS NULL").count() > 0
    assert landed["raw_marketing_clicks"].where("customer_id IS NULL").count() > 0


def test_seed_csv_as_shipped(spark, tmp_path):
    """A hand-written seed file: header, ISO times, names with spaces, empty fields; a malformed row fails the load."""
    seed = tmp_path / "raw_marketing_campaigns.csv"
    seed.write_text(
        "campaign_id,campaign_name,channel,campaign_type,budget_usd,started_at,ended_at\n"
        "CMP_0001,Retention Podcast Q3,podcast,retention,10000,2025-08-06T00:00:00,2025-09-30T00:00:00\n"
        "CMP_0002,  Brand Email Q1 ,email,brand,,2025-01-01T00:00:00,\n"
    )
    raw_dir = run_folder(spark, "test-shipped-seed")
    load_seed(spark, str(seed), "raw_marketing_campaigns", raw_dir)
    rows = read_landed(spark, raw_dir, "raw_marketing_campaigns").orderBy("campaign_id").collect()
    assert [(r.campaign_name, r.budget_usd, str(r.started_at), r.ended_at is None, r.batch_date) for r in rows] == [
        ("Retention Podcast Q3", 10000, "2025-08-06 00:00:00", False, None),
        ("  Brand Email Q1 ", None, "2025-01-01 00:00:00", True, None),
    ]
    seed.write_text(seed.read_text() + "CMP_0003,Bad,email,brand,many,2025-01-01T00:00:00,\n")
    with pytest.raises(Exception, match="(?i)malformed|many"):
        load_seed(spark, str(seed), "raw_marketing_campaigns", raw_dir)


def test_source_columns(spark, tmp_path):
    """Decimal amounts are read; a missing required column fails, a missing optional one is NULL."""
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    decimal = part.withColumn("p_retailprice", part["p_retailprice"].cast("decimal(12,2)"))
    decimal.write.parquet(str(tmp_path / "a" / "part.parquet"))
    part.withColumnRenamed("p_partkey", "key").write.parquet(str(tmp_path / "b" / "part.parquet"))
    own = Project.from_dir(spark, str(tmp_path / "a")).table("stg_products")
    given = Project.from_dir(spark, SF_SMALL).table("stg_products")
    assert own.schema == given.schema and _rows(own) == _rows(given)
    assert own.where("manufacturer IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="part lacks the columns p_partkey"):
        read_source(spark, str(tmp_path / "b"), "part")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_jvm_side_and_pruned(spark):
    queries = registered()
    skip = {"append_batch", "stream_append"}  # these write as they run
    for name, q in queries.items():
        if name in skip:
            continue
        plan = _plan(q(spark, SF_SMALL))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
    # scans read only the needed columns and carry pushed filters
    plan = _plan(queries["rpt_daily_revenue"](spark, SF_SMALL))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "l_" not in schema  # lineitem is not read for revenue
    formatted = queries["stg_marketing_campaigns"](spark, SF_SMALL)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PushedFilters: [IsNotNull(p_partkey)]" in formatted
    assert "ReadSchema: struct<p_partkey:bigint>" in formatted


def test_first_touch_needs_no_window(spark):
    plan = _plan(Project.from_dir(spark, SF_SMALL).table("int_customer_lifetime"))
    assert "Window" not in plan


def test_materialize_cuts_lineage(spark):
    p = Project.from_dir(spark, SF_SMALL)
    before = _rows(p.table("rpt_marketing_roi"))
    assert "orders.parquet" in _plan(p.table("rpt_marketing_roi"))
    p.materialize("int_customer_lifetime")
    # orders reach this report only through the customer roll-up, now read from the pinned files
    assert "orders.parquet" not in _plan(p.table("rpt_marketing_roi"))
    assert _rows(p.table("rpt_marketing_roi")) == before


def test_staging_views(spark):
    p = Project.from_dir(spark, SF_SMALL)
    p.register_views()
    n = spark.sql("SELECT count(*) AS n FROM stg_orders WHERE order_status = 'fulfilled'").first().n
    assert n == p.table("stg_orders").where("is_completed").count()


def test_order_grain_joins_are_co_partitioned(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan: what runs when nothing fits in memory
    try:
        plan = _plan(Project.from_dir(spark, SF_SMALL).table("int_orders_enriched"))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    assert len(exchanges) == 4  # orders, lines, payments, shipments: once each
    assert all(kind == "hashpartitioning" and "order_id" in cols for kind, cols in exchanges)
    assert plan.count("SortMergeJoin") == 3


ORDERS = {
    "rpt_customer_ltv": ("total_revenue_usd", True, True),
    "rpt_daily_revenue": ("paid_date", True, True),
    "rpt_executive_summary": ("report_month", True, True),
    "rpt_funnel": ("channel_revenue_usd", True, False),
    "rpt_marketing_roi": ("budget_usd", True, True),
}


def test_rows_of_reports_are_ordered(spark):
    p = Project.from_dir(spark, SF_SMALL)
    for name, (column, descending, nulls_first) in ORDERS.items():
        values = [r[column] for r in p.table(name).collect()]
        known = [v for v in values if v is not None]
        assert known == sorted(known, reverse=descending), name
        missing = [None] * (len(values) - len(known))
        assert values == (missing + known if nulls_first else known + missing), name


def test_building_a_model_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "models")
    p = Project.from_dir(spark, SF_SMALL)
    for name in CORE + REPORTS:
        p.table(name)
    started = [j for j in tracker.getJobIdsForGroup("building")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading the footers of the source tables is all that may run
    assert len(started) <= 5


def test_facts_are_few_files_a_year(spark):
    result = build_all(Project.from_dir(spark, SF_SMALL), with_checks=False)
    for name, column in (("fct_orders", "order_year"), ("fct_revenue", "paid_year")):
        files = spark.read.parquet(result.tables[name]).selectExpr("input_file_name() AS f", f"{column} AS y").distinct()
        assert max(r["count"] for r in files.groupBy("y").count().collect()) <= 2


def _scans(df) -> int:
    return _plan(df).count("FileScan parquet")


def test_scans_of_reports(spark):
    p = Project.from_dir(spark, SF_SMALL)
    for name in ("fct_revenue", "rpt_daily_revenue", "rpt_executive_summary"):
        assert _scans(p.table(name)) <= 8, name
    assert _plan(p.table("rpt_funnel")).count("events.parquet") == 2
    assert _scans(registered()["dq_summary"](spark, SF_SMALL)) <= 15
