"""Intermediate models: order, customer and product grain roll-ups.

Each child table is aggregated to the parent key *before* it is joined
(partial + final aggregation, so a hot key collapses map-side), and all
joins of one model share the same key, so Spark hash-partitions every side
once and chains the sort-merge joins inside one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillbook.functions.numeric import (
    ZERO_COUNT,
    ZERO_MONEY,
    exprs,
    flag_sum,
    mean_of,
    money_sum,
    stable_round,
)


def int_orders_enriched(
    orders: DataFrame, items: DataFrame, payments: DataFrame, shipments: DataFrame
) -> DataFrame:
    items_per_order = items.groupBy("order_id").agg(
        *exprs(
            "count(1) AS it_item_count",
            f"{money_sum('quantity')} AS it_total_quantity",
            f"{money_sum('line_total_usd')} AS it_items_subtotal_usd",
            f"{flag_sum('was_returned')} AS it_returned_item_count",
        )
    )
    payments_per_order = payments.groupBy("order_id").agg(
        *exprs(
            f"{money_sum('CASE WHEN is_captured THEN amount_usd ELSE CAST(0 AS DECIMAL(12,2)) END')}"
            " AS p_captured_amount_usd",
            "max(CASE WHEN is_captured THEN paid_at END) AS last_captured_at",
            "count(1) AS p_payment_attempt_count",
            f"{flag_sum('is_problem')} AS p_problem_payment_count",
        )
    )
    shipments_per_order = shipments.groupBy("order_id").agg(
        *exprs(
            "max(shipped_at) AS latest_shipped_at",
            "max(delivered_at) AS latest_delivered_at",
            "max(CASE WHEN is_delivered THEN 1 ELSE 0 END) AS s_has_delivery",
            "max(CASE WHEN is_returned THEN 1 ELSE 0 END) AS s_has_return",
        )
    )
    joined = (
        orders.join(items_per_order, "order_id", "left")
        .join(payments_per_order, "order_id", "left")
        .join(shipments_per_order, "order_id", "left")
    )
    return joined.selectExpr(
        "order_id",
        "customer_id",
        "order_date",
        "order_status",
        "priority",
        "is_completed",
        "order_total_usd",
        f"coalesce(it_item_count, {ZERO_COUNT}) AS item_count",
        f"coalesce(it_total_quantity, {ZERO_MONEY}) AS total_quantity",
        f"coalesce(it_items_subtotal_usd, {ZERO_MONEY}) AS items_subtotal_usd",
        f"coalesce(it_returned_item_count, {ZERO_COUNT}) AS returned_item_count",
        f"coalesce(p_captured_amount_usd, {ZERO_MONEY}) AS captured_amount_usd",
        "last_captured_at",
        f"coalesce(p_payment_attempt_count, {ZERO_COUNT}) AS payment_attempt_count",
        f"coalesce(p_problem_payment_count, {ZERO_COUNT}) AS problem_payment_count",
        "coalesce(p_captured_amount_usd > 0, false) AS has_payment",
        "latest_shipped_at",
        "latest_delivered_at",
        "coalesce(s_has_delivery, 0) = 1 AS is_delivered",
        "coalesce(s_has_return, 0) = 1 AS has_return",
        # fixed values: the four statuses.  captured IS NULL only when the order has no payment row at all: an
        # order whose payments all failed has captured = 0 and stays 'open'
        """CASE WHEN p_captured_amount_usd > 0 AND is_completed THEN 'completed'
                WHEN p_captured_amount_usd > 0 AND NOT is_completed THEN 'paid_pending'
                WHEN p_captured_amount_usd IS NULL AND is_completed THEN 'fulfilled_unpaid'
                ELSE 'open' END AS economic_status""",
    )


def first_touch(clicks: DataFrame) -> DataFrame:
    """Earliest click per customer (ties broken by click_id).

    Expressed as ``min(named_struct(...))`` — an aggregate with map-side
    partial aggregation — instead of ``row_number()`` over a window, so a
    customer with a third of all clicks costs one row per map task rather
    than a single sorted partition.  The leading NULL flag keeps clicks
    without a time last, as an ascending sort would.
    """
    touch = "min(named_struct('late', clicked_at IS NULL, 'at', clicked_at, 'id', click_id, 'campaign', campaign_id))"
    return (
        clicks.where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(*exprs(f"{touch} AS t"))
        .selectExpr("customer_id", "t.campaign AS acquisition_campaign_id", "t.at AS acquired_at")
    )


def lifecycle_segment(total_orders: str) -> str:
    # fixed values: labels and order counts
    return f"""CASE WHEN {total_orders} IS NULL OR {total_orders} = 0 THEN 'never_ordered'
                    WHEN {total_orders} = 1 THEN 'one_time'
                    WHEN {total_orders} BETWEEN 2 AND 5 THEN 'repeat'
                    ELSE 'loyal' END"""


def int_customer_lifetime(
    customers: DataFrame, orders_enriched: DataFrame, clicks: DataFrame, as_of: str
) -> DataFrame:
    """``as_of`` is the reference clock as a SQL expression."""
    order_aggregates = (
        orders_enriched.where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(
            *exprs(
                "count(1) AS o_total_orders",
                f"{money_sum('captured_amount_usd')} AS o_total_revenue_usd",
                "min(order_date) AS first_order_date",
                "max(order_date) AS last_order_date",
                f"{flag_sum('is_delivered')} AS o_delivered_orders",
                f"{flag_sum('has_return')} AS o_returned_orders",
                f"{mean_of('captured_amount_usd')} AS avg_order_value_usd",
            )
        )
    )
    joined = customers.join(order_aggregates, "customer_id", "left").join(
        first_touch(clicks), "customer_id", "left"
    )
    return joined.selectExpr(
        "customer_id",
        "full_name",
        "market_segment",
        "account_balance_usd",
        f"coalesce(o_total_orders, {ZERO_COUNT}) AS total_orders",
        f"coalesce(o_total_revenue_usd, {ZERO_MONEY}) AS total_revenue_usd",
        f"coalesce(o_delivered_orders, {ZERO_COUNT}) AS delivered_orders",
        f"coalesce(o_returned_orders, {ZERO_COUNT}) AS returned_orders",
        "avg_order_value_usd",
        "first_order_date",
        "last_order_date",
        f"coalesce(last_order_date >= CAST(date_sub(to_date({as_of}), 90) AS TIMESTAMP_NTZ), false) AS is_active",
        "acquisition_campaign_id",
        "acquired_at",
        f"{lifecycle_segment('o_total_orders')} AS customer_segment_lifecycle",
    )


def sales_tier(units: str) -> str:
    # fixed values: labels and unit counts
    return f"""CASE WHEN {units} >= 10000 THEN 'bestseller'
                    WHEN {units} >= 1000 THEN 'strong'
                    WHEN {units} >= 100 THEN 'steady'
                    WHEN {units} > 0 THEN 'slow'
                    ELSE 'no_sales' END"""


def int_product_performance(products: DataFrame, items: DataFrame) -> DataFrame:
    """Per-product sales.

    The distinct-order count and the sums are two aggregations joined on the
    product key.  Together in one aggregate, Spark would carry every partial
    sum through the (product, order) shuffle of all line rows; apart, that
    shuffle moves two keys per line and the sums combine map-side into one
    row per product and task — a second columnar scan of the lines is far
    cheaper than the wider shuffle."""
    zero = "CAST(0 AS DECIMAL(12,2))"
    sums = items.groupBy("product_id").agg(
        *exprs(
            f"{money_sum('quantity')} AS s_units_sold",
            f"{money_sum('line_total_usd')} AS s_gross_revenue_usd",
            f"{money_sum(f'CASE WHEN was_returned THEN quantity ELSE {zero} END')} AS s_units_returned",
            f"{money_sum(f'CASE WHEN was_returned THEN line_total_usd ELSE {zero} END')} AS s_returned_revenue_usd",
            f"{stable_round('avg(CAST(line_total_usd AS DOUBLE) / CAST(nullif(quantity, 0) AS DOUBLE))', 6)}"
            " AS avg_unit_price_usd",
        )
    )
    distinct_orders = items.groupBy("product_id").agg(
        *exprs("count(DISTINCT order_id) AS s_orders_containing_product")
    )
    # Both sides have exactly the same product keys, so LEFT equals INNER
    # here; LEFT lets Catalyst drop the distinct count for consumers that
    # never read it (the product dimension).
    product_sales = sums.join(distinct_orders, "product_id", "left")
    units = f"coalesce(s_units_sold, {ZERO_MONEY})"
    return_rate = stable_round("(CAST(s_units_returned AS DOUBLE) / CAST(s_units_sold AS DOUBLE)) * 100.0D", 2)
    return products.join(product_sales, "product_id", "left").selectExpr(
        "product_id",
        "product_name",
        "brand",
        "manufacturer",
        "quality_tier",
        "material",
        "product_size",
        "retail_price_usd",
        f"{units} AS units_sold",
        f"coalesce(s_orders_containing_product, {ZERO_COUNT}) AS orders_containing_product",
        f"coalesce(s_gross_revenue_usd, {ZERO_MONEY}) AS gross_revenue_usd",
        f"coalesce(s_units_returned, {ZERO_MONEY}) AS units_returned",
        f"coalesce(s_returned_revenue_usd, {ZERO_MONEY}) AS returned_revenue_usd",
        "avg_unit_price_usd",
        f"CASE WHEN s_units_sold IS NULL OR s_units_sold = 0 THEN 0.0D ELSE {return_rate} END AS return_rate_pct",
        f"{sales_tier(units)} AS sales_tier",
    )
