"""Core marts: customer and product dimensions, order and revenue facts.

``as_of`` arguments are the reference clock as a SQL expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions.dates import day_diff, day_of_week
from tillbook.functions.numeric import stable_round
from tillbook.operators.skew import ROWS_PER_TASK, salted_left_join


def dim_customers(lifetime: DataFrame, as_of: str) -> DataFrame:
    return_rate = stable_round("(CAST(returned_orders AS DOUBLE) / CAST(total_orders AS DOUBLE)) * 100.0D", 2)
    return lifetime.selectExpr(
        "customer_id",
        "full_name",
        "market_segment",
        "customer_segment_lifecycle AS lifetime_segment",
        "total_orders",
        "total_revenue_usd",
        "avg_order_value_usd",
        "first_order_date",
        "last_order_date",
        "is_active",
        "acquisition_campaign_id",
        "acquired_at",
        "delivered_orders",
        "returned_orders",
        f"CASE WHEN total_orders > 0 THEN {return_rate} ELSE 0.0D END AS return_rate_pct",
        f"{as_of} AS dim_last_refreshed_at",
    )


def dim_products(performance: DataFrame, as_of: str) -> DataFrame:
    return performance.selectExpr(
        "product_id",
        "product_name",
        "brand",
        "manufacturer",
        "quality_tier",
        "material",
        "product_size",
        "retail_price_usd",
        "units_sold",
        "gross_revenue_usd",
        "return_rate_pct",
        "sales_tier",
        # fixed values: the three roles
        """CASE WHEN sales_tier IN ('bestseller', 'strong') THEN 'core_catalog'
                WHEN sales_tier IN ('steady', 'slow') THEN 'long_tail'
                ELSE 'unsold' END AS catalog_role""",
        f"{as_of} AS dim_last_refreshed_at",
    )


def fct_orders(orders_enriched: DataFrame, as_of: str) -> DataFrame:
    return orders_enriched.selectExpr(
        "order_id",
        "customer_id",
        "order_date",
        "year(order_date) AS order_year",
        "quarter(order_date) AS order_quarter",
        "month(order_date) AS order_month",
        f"{day_of_week('order_date')} AS order_day_of_week",
        "order_status",
        "economic_status",
        "priority",
        "is_completed",
        "is_delivered",
        "has_return",
        "item_count",
        "total_quantity",
        "items_subtotal_usd",
        "captured_amount_usd AS revenue_usd",
        "order_total_usd",
        "payment_attempt_count",
        "problem_payment_count",
        # fixed values: the three states
        """CASE WHEN problem_payment_count > 0 AND NOT is_completed THEN 'at_risk'
                WHEN problem_payment_count > 0 THEN 'recovered'
                ELSE 'clean' END AS payment_health""",
        "latest_shipped_at",
        "latest_delivered_at",
        f"CASE WHEN latest_delivered_at IS NOT NULL THEN {day_diff('order_date', 'latest_delivered_at')} END"
        " AS days_to_delivery",
        f"{as_of} AS fact_last_refreshed_at",
    )


def paid_orders(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Captured payments with their order's customer and priority, and their calendar columns.

    All that reports read of the revenue fact but its customer segments."""
    captured = payments.where("is_captured").select(
        "payment_id", "order_id", "customer_id", "amount_usd", "payment_method", "paid_at"
    )
    order_side = orders.selectExpr("order_id", "customer_id AS order_customer_id", "priority AS order_priority")
    return captured.join(order_side, "order_id", "inner").selectExpr("*", "amount_usd AS revenue_usd", "to_date(paid_at) AS paid_date")


def fct_revenue(paid: DataFrame, lifetime: DataFrame, as_of: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Captured payments with order priority and customer segments.

    The reference joins orders to the customer roll-up and then payments to
    that lookup.  Joining captured payments to orders first (inner, on
    order_id) and only then to the customer roll-up (left, on the order's
    customer) is equivalent and shrinks the customer-keyed join from all
    orders to captured payments.  A customer may own a third of them, and
    orders may lack a customer: the join spreads both.
    """
    segments = lifetime.selectExpr(
        "customer_id AS order_customer_id", "market_segment AS customer_segment", "customer_segment_lifecycle"
    )
    joined = salted_left_join(paid, segments, "order_customer_id", F.col("payment_id"), rows_per_task)
    return joined.selectExpr(
        "payment_id",
        "order_id",
        "customer_id",
        "revenue_usd",
        "payment_method",
        "paid_at",
        "paid_date",
        "year(paid_at) AS paid_year",
        "quarter(paid_at) AS paid_quarter",
        "month(paid_at) AS paid_month",
        "weekofyear(paid_at) AS paid_week",
        "order_priority",
        "customer_segment",
        "customer_segment_lifecycle",
        f"{as_of} AS fact_last_refreshed_at",
    )
