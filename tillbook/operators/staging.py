"""Staging models: typed, renamed, lightly cleaned views of each raw input.

All of them are narrow projections + filters, so Catalyst fuses each into the
parquet scan's whole-stage-codegen span; nothing here shuffles.  They are
written as SQL expressions (``selectExpr``), which compile to the same plan
as Column expressions and cost one JVM call per column to build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillbook.functions.dates import day_diff

# ---- fixed values (code maps of the reference) -------------------------------
ORDER_STATUS = {"O": "open", "F": "fulfilled", "P": "pending"}
ORDER_PRIORITY = {
    "1-URGENT": "urgent",
    "2-HIGH": "high",
    "3-MEDIUM": "medium",
    "4-NOT SPECIFIED": "normal",
    "5-LOW": "low",
}
LINE_STATUS = {"O": "open", "F": "fulfilled"}
RETURN_FLAGS = ["R", "A"]
PROBLEM_PAYMENT_STATUSES = ["failed", "refunded"]
# -------------------------------------------------------------------------------


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def decode_sql(column: str, mapping: dict[str, str], default: str) -> str:
    """Simple ``case column when k then v … else default end``."""
    branches = " ".join(f"WHEN {_quote(k)} THEN {_quote(v)}" for k, v in mapping.items())
    return f"CASE {column} {branches} ELSE {_quote(default)} END"


def in_sql(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(_quote(v) for v in values)})"


def is_true_sql(cond: str) -> str:
    """``case when cond then true else false end`` (NULL -> false)."""
    return f"coalesce({cond}, false)"


def staged(raw: DataFrame, condition: str, *columns: str) -> DataFrame:
    """The rows of a staging view."""
    return raw.where(condition).selectExpr(*columns)


def beside_source(raw: DataFrame, condition: str, *columns: str) -> DataFrame:
    """All raw rows: the raw columns in ``_src``, the view's columns, and ``_staged``, whether the view has the row."""
    return raw.selectExpr("struct(*) AS _src", *columns, f"coalesce({condition}, false) AS _staged")


def stg_customers(customer: DataFrame, stage=staged) -> DataFrame:
    return stage(
        customer,
        "c_custkey IS NOT NULL",
        "c_custkey AS customer_id",
        "trim(c_name) AS full_name",
        "trim(c_address) AS address",
        "c_nationkey AS nation_id",
        "c_phone AS phone",
        "CAST(c_acctbal AS DECIMAL(12,2)) AS account_balance_usd",
        "c_mktsegment AS market_segment",
        "trim(c_comment) AS customer_notes",
    )


def stg_orders(orders: DataFrame, stage=staged) -> DataFrame:
    return stage(
        orders,
        "o_orderkey IS NOT NULL",
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS order_total_usd",
        "o_orderdate AS order_date",
        f"{decode_sql('o_orderstatus', ORDER_STATUS, 'unknown')} AS order_status",
        f"{decode_sql('o_orderpriority', ORDER_PRIORITY, 'normal')} AS priority",
        "trim(o_clerk) AS sales_clerk",
        "o_shippriority AS shipping_priority",
        f"{is_true_sql("o_orderstatus = 'F'")} AS is_completed",
    )


def stg_order_items(lineitem: DataFrame, stage=staged) -> DataFrame:
    price = "CAST(l_extendedprice AS DECIMAL(12,2))"
    discount = "CAST(l_discount AS DECIMAL(5,4))"
    tax = "CAST(l_tax AS DECIMAL(5,4))"
    return stage(
        lineitem,
        "l_orderkey IS NOT NULL",
        "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS order_item_id",
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "l_suppkey AS supplier_id",
        "l_linenumber AS line_number",
        "CAST(l_quantity AS DECIMAL(8,2)) AS quantity",
        f"{price} AS gross_amount_usd",
        f"{discount} AS discount_pct",
        f"{tax} AS tax_pct",
        f"CAST({price} * (1 - {discount}) * (1 + {tax}) AS DECIMAL(12,2)) AS line_total_usd",
        "l_shipdate AS shipped_date",
        "l_commitdate AS committed_date",
        "l_receiptdate AS receipt_date",
        f"{is_true_sql(in_sql('l_returnflag', RETURN_FLAGS))} AS was_returned",
        f"{decode_sql('l_linestatus', LINE_STATUS, 'unknown')} AS line_status",
    )


def stg_products(part: DataFrame, stage=staged) -> DataFrame:
    return stage(
        part,
        "p_partkey IS NOT NULL",
        "p_partkey AS product_id",
        "trim(p_name) AS product_name",
        "p_mfgr AS manufacturer",
        "p_brand AS brand",
        "p_type AS product_type",
        "split_part(p_type, ' ', 1) AS quality_tier",
        "split_part(p_type, ' ', -1) AS material",
        "CAST(p_size AS INT) AS product_size",
        "p_container AS container",
        "CAST(p_retailprice AS DECIMAL(12,2)) AS retail_price_usd",
        "trim(p_comment) AS product_notes",
    )


def stg_payments(raw_payments: DataFrame, as_of: str, stage=staged) -> DataFrame:
    """``as_of`` is the reference clock as a SQL expression."""
    paid_at = "CAST(paid_at AS TIMESTAMP_NTZ)"
    review = f"status = 'pending' AND {paid_at} < timestampadd(HOUR, -24, {as_of})"
    return stage(
        raw_payments,
        "payment_id IS NOT NULL AND amount_usd > 0",
        "payment_id",
        "order_id",
        "customer_id",
        "CAST(amount_usd AS DECIMAL(12,2)) AS amount_usd",
        "payment_method",
        "status AS payment_status",
        f"{paid_at} AS paid_at",
        f"{is_true_sql("status = 'captured'")} AS is_captured",
        f"{is_true_sql(in_sql('status', PROBLEM_PAYMENT_STATUSES))} AS is_problem",
        f"{is_true_sql(review)} AS needs_review",
    )


def stg_shipments(raw_shipments: DataFrame, stage=staged) -> DataFrame:
    shipped, delivered = "CAST(shipped_at AS TIMESTAMP_NTZ)", "CAST(delivered_at AS TIMESTAMP_NTZ)"
    return stage(
        raw_shipments,
        "shipment_id IS NOT NULL",
        "shipment_id",
        "order_id",
        "carrier",
        "tracking_number",
        "status AS shipment_status",
        f"{shipped} AS shipped_at",
        f"{delivered} AS delivered_at",
        f"{is_true_sql("status = 'delivered'")} AS is_delivered",
        f"{is_true_sql("status = 'returned'")} AS is_returned",
        f"CASE WHEN {delivered} IS NOT NULL THEN {day_diff(shipped, delivered)} END AS delivery_time_days",
    )


def stg_marketing_campaigns(raw_campaigns: DataFrame, as_of: str, stage=staged) -> DataFrame:
    """``as_of`` is the reference clock as a SQL expression."""
    started, ended = "CAST(started_at AS TIMESTAMP_NTZ)", "CAST(ended_at AS TIMESTAMP_NTZ)"
    return stage(
        raw_campaigns,
        "campaign_id IS NOT NULL",
        "campaign_id",
        "trim(campaign_name) AS campaign_name",
        "channel",
        "campaign_type",
        "CAST(budget_usd AS DECIMAL(12,2)) AS budget_usd",
        f"{started} AS started_at",
        f"{ended} AS ended_at",
        f"{day_diff(started, ended)} AS duration_days",
        f"{is_true_sql(f'{as_of} BETWEEN {started} AND {ended}')} AS is_active",
    )


def stg_marketing_clicks(raw_clicks: DataFrame, stage=staged) -> DataFrame:
    return stage(
        raw_clicks,
        "click_id IS NOT NULL",
        "click_id",
        "campaign_id",
        "customer_id",
        "CAST(clicked_at AS TIMESTAMP_NTZ) AS clicked_at",
        "source_url",
        "CAST(converted AS BOOLEAN) AS did_convert",
        "customer_id IS NULL AS is_anonymous",
    )
