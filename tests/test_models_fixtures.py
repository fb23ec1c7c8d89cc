"""Branch-level behaviour of the models on hand-written rows (FIXTURES.md §4)."""

from decimal import Decimal

from tests.fixtures import (
    campaign,
    click,
    customer,
    line,
    order,
    part,
    payment,
    project,
    rows_by,
    shipment,
    ts,
)


def test_order_status_priority_defaults(spark):
    p = project(spark, orders=[
        order(1, 1, status="X", priority="9-WHATEVER"),
        order(2, 1, status=None, priority=None),
        order(3, 1, status="F", priority="4-NOT SPECIFIED"),
    ])
    got = rows_by(p.table("stg_orders"), "order_id")
    assert (got[1]["order_status"], got[1]["priority"], got[1]["is_completed"]) == ("unknown", "normal", False)
    assert (got[2]["order_status"], got[2]["priority"], got[2]["is_completed"]) == ("unknown", "normal", False)
    assert (got[3]["order_status"], got[3]["priority"], got[3]["is_completed"]) == ("fulfilled", "normal", True)


def test_product_type_words(spark):
    p = project(spark, part=[part(1, "STANDARD ANODIZED STEEL"), part(2, "BRASS")])
    got = rows_by(p.table("stg_products"), "product_id")
    assert (got[1]["quality_tier"], got[1]["material"]) == ("STANDARD", "STEEL")
    assert (got[2]["quality_tier"], got[2]["material"]) == ("BRASS", "BRASS")


def test_payment_review_window_and_zero_amount(spark):
    p = project(spark, raw_payments=[
        payment("a", 1, status="pending", paid="2001-07-31 00:00:00"),  # exactly 24h old
        payment("b", 1, status="pending", paid="2001-07-30 23:59:59"),  # 24h + 1s old
        payment("c", 1, status="captured", paid="2001-01-01 00:00:00"),
        payment("z", 1, amount=0.0),  # dropped by amount_usd > 0
    ])
    got = rows_by(p.table("stg_payments"), "payment_id")
    assert set(got) == {"a", "b", "c"}
    assert got["a"]["needs_review"] is False and got["b"]["needs_review"] is True
    assert got["c"]["needs_review"] is False and got["c"]["is_captured"] is True


def test_delivery_days_count_midnights(spark):
    p = project(spark, raw_shipments=[
        shipment("s1", 1),  # 23:00 -> 01:00 next day
        shipment("s2", 2, status="in_transit", delivered=None),
    ])
    got = rows_by(p.table("stg_shipments"), "shipment_id")
    assert got["s1"]["delivery_time_days"] == 1
    assert got["s2"]["delivery_time_days"] is None


def test_campaign_active_on_both_bounds(spark):
    p = project(spark, raw_marketing_campaigns=[
        campaign("c1", start="2001-08-01 00:00:00", end="2001-09-01 00:00:00"),
        campaign("c2", start="2001-07-01 00:00:00", end="2001-08-01 00:00:00"),
        campaign("c3", start="2001-07-01 00:00:00", end="2001-07-31 23:59:59"),
    ])
    got = rows_by(p.table("stg_marketing_campaigns"), "campaign_id")
    assert got["c1"]["is_active"] and got["c2"]["is_active"] and not got["c3"]["is_active"]
    assert got["c1"]["campaign_name"] == "c1"


def test_economic_status_traps(spark):
    p = project(
        spark,
        orders=[order(1, 1, status="F"), order(2, 1, status="F"), order(3, 1, status="O"), order(4, 1, status="F")],
        raw_payments=[
            payment("p1", 1, status="failed"),
            payment("p3", 3, status="captured"),
            payment("p4", 4, status="captured"),
        ],
    )
    got = rows_by(p.table("int_orders_enriched"), "order_id")
    assert (got[1]["economic_status"], got[1]["has_payment"]) == ("open", False)  # payments exist, none captured
    assert got[2]["economic_status"] == "fulfilled_unpaid"
    assert got[3]["economic_status"] == "paid_pending"
    assert got[4]["economic_status"] == "completed"
    assert got[1]["captured_amount_usd"] == Decimal("0.00") and got[2]["payment_attempt_count"] == 0


def test_lifecycle_activity_and_first_touch(spark):
    counts = {1: 0, 2: 1, 3: 2, 4: 5, 5: 6}
    orders, key = [], 100
    for cust, n in counts.items():
        for _ in range(n):
            orders.append(order(key, cust, date="2001-01-01 00:00:00"))
            key += 1
    orders.append(order(900, 6, date="2001-05-03 00:00:00"))  # 90 days before as_of
    orders.append(order(901, 7, date="2001-05-02 23:00:00"))  # just over 90 days
    customers = [customer(c) for c in range(1, 8)]
    clicks = [
        click("k2", "CMP_B", 2, at="2001-01-01 10:00:00"),
        click("k1", "CMP_A", 2, at="2001-01-01 10:00:00"),  # tie: smaller click id wins
        click("k3", "CMP_C", 2, at="2001-01-01 11:00:00"),
        click("k9", "CMP_A", None, at="2000-01-01 00:00:00"),  # anonymous, ignored
    ]
    p = project(spark, customer=customers, orders=orders, raw_marketing_clicks=clicks)
    got = rows_by(p.table("int_customer_lifetime"), "customer_id")
    assert [got[c]["customer_segment_lifecycle"] for c in range(1, 6)] == [
        "never_ordered", "one_time", "repeat", "repeat", "loyal"]
    assert got[6]["is_active"] is True and got[7]["is_active"] is False
    assert got[1]["is_active"] is False and got[1]["total_orders"] == 0
    assert got[2]["acquisition_campaign_id"] == "CMP_A"
    assert got[2]["acquired_at"] == ts("2001-01-01 10:00:00")


def test_sales_tiers_and_zero_quantity(spark):
    units = {1: 0, 2: 1, 3: 100, 4: 1000, 5: 10000}
    lines = [line(10 + k, k, qty=float(q), price=10.0) for k, q in units.items() if q > 0]
    lines.append(line(50, 6, qty=0.0, price=5.0))
    p = project(spark, part=[part(k) for k in range(1, 7)], lineitem=lines)
    got = rows_by(p.table("int_product_performance"), "product_id")
    assert [got[k]["sales_tier"] for k in range(1, 6)] == ["no_sales", "slow", "steady", "strong", "bestseller"]
    assert got[6]["avg_unit_price_usd"] is None and got[6]["sales_tier"] == "no_sales"
    assert got[1]["return_rate_pct"] == 0.0
    dims = rows_by(p.table("dim_products"), "product_id")
    assert [dims[k]["catalog_role"] for k in range(1, 6)] == [
        "unsold", "long_tail", "long_tail", "core_catalog", "core_catalog"]


def test_payment_health_and_day_of_week(spark):
    p = project(
        spark,
        orders=[order(1, 1, status="O", date="2001-07-01 00:00:00"), order(2, 1, status="F")],
        raw_payments=[payment("a", 1, status="refunded"), payment("b", 2, status="failed")],
    )
    got = rows_by(p.table("fct_orders"), "order_id")
    assert got[1]["payment_health"] == "at_risk" and got[2]["payment_health"] == "recovered"
    assert got[1]["order_day_of_week"] == 0  # 2001-07-01 is a Sunday


def test_revenue_drops_unknown_orders(spark):
    p = project(
        spark,
        customer=[customer(1)],
        orders=[order(1, 1)],
        raw_payments=[payment("a", 1), payment("orphan", 999)],
    )
    got = rows_by(p.table("fct_revenue"), "payment_id")
    assert set(got) == {"a"}
    assert got["a"]["customer_segment"] == "BUILDING"


def test_daily_revenue_row_based_lag_and_zero_prior(spark):
    p = project(
        spark,
        customer=[customer(1)],
        orders=[order(k, 1) for k in range(1, 6)],
        raw_payments=[
            payment("d1", 1, amount=10.0, paid="2001-02-01 10:00:00"),
            payment("d2", 2, amount=30.0, paid="2001-02-02 10:00:00"),
            payment("d4", 3, amount=60.0, paid="2001-02-04 10:00:00"),
        ],
    )
    got = rows_by(p.table("rpt_daily_revenue"), "paid_date")
    d4 = [v for k, v in got.items() if k.day == 4][0]
    assert d4["prior_day_revenue_usd"] == Decimal("30.00")  # day 3 missing: compares to day 2
    assert d4["day_over_day_change_pct"] == 100.0
    assert d4["rolling_7d_avg_usd"] == 33.33


def test_median_interpolates_even_groups(spark):
    custs = [customer(c, segment="AUTOMOBILE") for c in range(1, 5)]
    orders = [order(c, c) for c in range(1, 5)]
    pays = [payment(f"p{c}", c, amount=amt) for c, amt in zip(range(1, 5), [1.0, 2.0, 3.35, 100.0])]
    p = project(spark, customer=custs, orders=orders, raw_payments=pays)
    (row,) = p.table("rpt_customer_ltv").collect()
    assert row["median_ltv_usd"] == 2.68  # (2 + 3.35) / 2 = 2.675, half-up
    assert row["customer_count"] == 4


def test_marketing_roi_guards(spark):
    p = project(
        spark,
        customer=[customer(1)],
        orders=[order(1, 1)],
        raw_payments=[payment("a", 1, amount=50.0)],
        raw_marketing_campaigns=[campaign("A", budget=0), campaign("B", budget=100), campaign("C", budget=100)],
        raw_marketing_clicks=[click("k1", "A", 1), click("k2", "B", None, converted=True)],
    )
    got = rows_by(p.table("rpt_marketing_roi"), "campaign_id")
    assert got["A"]["roi_multiplier"] is None and got["A"]["customers_acquired"] == 1
    assert got["A"]["cost_per_acquisition_usd"] == 0.0
    assert got["C"]["conversion_rate_pct"] == 0.0 and got["C"]["cost_per_click_usd"] is None
    assert got["C"]["cost_per_acquisition_usd"] is None and got["C"]["attributed_revenue_usd"] == Decimal("0.00")
    assert got["B"]["conversion_rate_pct"] == 100.0 and got["B"]["unique_clickers"] == 0


def test_funnel_conversions_without_acquisitions(spark):
    p = project(
        spark,
        customer=[customer(1)],
        raw_marketing_campaigns=[campaign("A", channel="email"), campaign("B", channel="tiktok")],
        raw_marketing_clicks=[click("k1", "B", None, converted=True), click("k2", "A", 1)],
    )
    got = rows_by(p.table("rpt_funnel"), "channel")
    assert got["tiktok"]["conversions"] == 1 and got["tiktok"]["conversion_to_paid_pct"] is None
    assert got["email"]["paying_customers"] == 1 and got["email"]["conversion_to_paid_pct"] == 0.0


def test_executive_summary_months_from_single_inputs(spark):
    p = project(
        spark,
        customer=[customer(1), customer(2)],
        orders=[order(1, 1, date="2001-01-15 00:00:00")],
        raw_payments=[payment("a", 1, paid="2001-03-05 00:00:00")],
        raw_marketing_clicks=[click("k", "A", 2, at="2001-05-05 00:00:00")],
        raw_marketing_campaigns=[campaign("A")],
    )
    got = {r["report_month"].month: r.asDict() for r in p.table("rpt_executive_summary").collect()}
    assert sorted(got) == [1, 3, 5]
    assert got[1]["orders_placed"] == 1 and got[1]["revenue_usd"] == Decimal("0.00")
    assert got[3]["orders_paid"] == 1 and got[3]["orders_placed"] == 0 and got[3]["return_rate_pct"] == 0.0
    assert got[5]["new_customers"] == 1 and got[5]["avg_delivery_days"] is None
