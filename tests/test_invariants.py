
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillbook.plans.graph import Project


@pytest.fixture(scope="module")
def project(spark):
    return Project.from_dir(spark, SF_SMALL)


def _count(p, name):
    return p.table(name).count()


def _sum(p, name, col):
    return p.table(name).agg(F.sum(col)).first()[0]


def test_grain_preserving_models(project):
    assert _count(project, "int_orders_enriched") == _count(project, "stg_orders")
    assert _count(project, "int_customer_lifetime") == _count(project, "stg_customers")
    assert _count(project, "int_product_performance") == _count(project, "stg_products")
    assert _count(project, "fct_orders") == _count(project, "stg_orders")
    assert _count(project, "dim_customers") == _count(project, "stg_customers")


def test_revenue_totals_agree(project):
    daily = _sum(project, "rpt_daily_revenue", "revenue_usd")
    assert daily == _sum(project, "fct_revenue", "revenue_usd")
    monthly = _sum(project, "rpt_executive_summary", "revenue_usd")
    assert monthly == daily
    captured = _sum(project, "fct_orders", "revenue_usd")
    # every captured payment belongs to a known order in the derived data
    assert captured == daily


def test_counts_roll_up(project):
    assert _sum(project, "rpt_executive_summary", "orders_placed") == _count(project, "fct_orders")
    assert _sum(project, "rpt_customer_ltv", "customer_count") == _count(project, "dim_customers")
    assert _sum(project, "rpt_daily_revenue", "payment_count") == _count(project, "fct_revenue")
    roi = project.table("rpt_marketing_roi")
    clicks = project.table("stg_marketing_clicks")
    assert roi.agg(F.sum("click_count")).first()[0] == clicks.count()
    funnel_clicks = _sum(project, "rpt_funnel", "total_clicks")
    assert funnel_clicks == clicks.count()
    assert _sum(project, "rpt_funnel", "paying_customers") == _sum(project, "rpt_marketing_roi", "customers_acquired")
