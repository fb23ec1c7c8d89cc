"""Deterministic derivation of the supplemental raw tables.

The reference ships randomly generated seed files for payments, shipments,
campaigns and clicks.  Here they are pure projections of the source tables
(integer arithmetic on the keys), so the same rows come out at every scale
and on every engine, and the work grows with the source tables.

The projections are written as SQL expressions (``selectExpr``): Catalyst
compiles them to the same plan as the Column API, and each column is one
call into the JVM when the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillbook.functions.dates import add_hours

# ---- fixed values (must equal the reference's vocabularies) ----------------
PAYMENT_METHODS = ["credit_card", "debit_card", "ach", "paypal", "apple_pay"]
CHANNELS = ["google_ads", "facebook", "email", "instagram", "tiktok", "podcast"]
CAMPAIGN_TYPES = ["acquisition", "retention", "reactivation", "brand"]
LANDING_PAGES = ["summer-sale", "new-arrivals", "holiday", "clearance", "newsletter"]
CARRIERS = ["UPS", "FedEx", "USPS", "DHL"]
BUDGET_TIERS = [2500, 5000, 10000, 25000, 50000, 100000]
PAYMENT_STATUSES = ["captured", "captured", "captured", "captured", "captured", "pending", "failed", "refunded"]
SHIPMENT_STATUSES = ["delivered", "delivered", "delivered", "in_transit", "delayed", "returned"]
# -----------------------------------------------------------------------------

CAMPAIGN_EPOCH = "1999-08-01 00:00:00"
#: Campaigns that events click on, and the length of a round of start dates.
CLICKED_CAMPAIGNS = 40


def pick_sql(values: list, index_sql: str) -> str:
    """``values[index]`` with a 0-based index, as a literal array lookup."""
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"get(array({items}), CAST({index_sql} AS INT))"


def pad_sql(x_sql: str, width: int) -> str:
    """Left-pad an integer with zeros; never truncates wider values."""
    return f"format_string('%0{width}d', {x_sql})"


def derive_raw_payments(orders: DataFrame) -> DataFrame:
    """One payment attempt for 17 of every 20 orders, a second attempt for
    orders whose key ends in 3 (single scan: the attempts are exploded)."""
    k = "o_orderkey"
    base = orders.where("o_orderkey IS NOT NULL AND o_orderkey % 20 < 17").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "explode(IF(o_orderkey % 10 = 3, array(1, 2), array(1))) AS att",
    )
    return base.selectExpr(
        f"concat('PMT_', {pad_sql(k, 8)}, '_', CAST(att AS STRING)) AS payment_id",
        f"{k} AS order_id",
        "o_custkey AS customer_id",
        f"""CASE WHEN {k} % 97 = 0 THEN CAST(0 AS DECIMAL(12,2))
                 ELSE CAST(CAST(1500 + ({k} * 7919 + att * 131) % 498500 AS DECIMAL(20,0)) * 0.01 AS DECIMAL(12,2))
            END AS amount_usd""",
        f"CASE WHEN {k} % 19 = 7 THEN NULL ELSE {pick_sql(PAYMENT_METHODS, f'({k} + att) % 5')} END AS payment_method",
        f"{pick_sql(PAYMENT_STATUSES, f'({k} * 13 + att * 3) % 8')} AS status",
        f"{add_hours('o_orderdate', f'({k} * 37 + att * 29) % 8760')} AS paid_at",
    )


def derive_raw_shipments(orders: DataFrame) -> DataFrame:
    """One shipment for three of every four orders."""
    k, status = "o_orderkey", "(o_orderkey * 11) % 6"
    shipped = add_hours("o_orderdate", f"24 * (1 + ({k} * 17) % 30) + {k} % 24")
    return orders.where("o_orderkey IS NOT NULL AND o_orderkey % 4 <> 3").selectExpr(
        f"concat('SHIP_', {pad_sql(k, 8)}) AS shipment_id",
        f"{k} AS order_id",
        f"{pick_sql(CARRIERS, f'({k} * 3 + {k} % 7) % 4')} AS carrier",
        f"concat('TR', CAST(100000000 + ({k} * 104729) % 899999999 AS STRING)) AS tracking_number",
        f"{pick_sql(SHIPMENT_STATUSES, status)} AS status",
        f"{shipped} AS shipped_at",
        f"CASE WHEN {status} < 3 THEN {add_hours(shipped, f'24 * (2 + {k} % 7) + {k} % 13')} END AS delivered_at",
    )


def derive_raw_marketing_campaigns(part: DataFrame) -> DataFrame:
    """One campaign per part; start dates go round after ``CLICKED_CAMPAIGNS``, the last of each round has no budget."""
    i = "(p_partkey + 1)"
    ctype = pick_sql(CAMPAIGN_TYPES, f"({i} * 7) % 4")
    channel = pick_sql(CHANNELS, f"{i} % 6")
    epoch = f"CAST('{CAMPAIGN_EPOCH}' AS TIMESTAMP_NTZ)"
    days = f"18 * (p_partkey % {CLICKED_CAMPAIGNS} + 1)"
    return part.where("p_partkey IS NOT NULL").selectExpr(
        f"concat('CMP_', {pad_sql(i, 4)}) AS campaign_id",
        f"concat('  ', {ctype}, ' ', {channel}, ' ') AS campaign_name",
        f"{channel} AS channel",
        f"{ctype} AS campaign_type",
        f"CAST(CASE WHEN {i} % {CLICKED_CAMPAIGNS} = 0 THEN 0 ELSE {pick_sql(BUDGET_TIERS, f'({i} * 5 + {i} % 7) % 6')} END AS BIGINT)"
        " AS budget_usd",
        f"{add_hours(epoch, f'24 * ({days})')} AS started_at",
        f"{add_hours(epoch, f'24 * ({days} + 7 + ({i} * 11) % 84)')} AS ended_at",
    )


def derive_raw_marketing_clicks(events: DataFrame) -> DataFrame:
    """Every event becomes a click; 3 in 10 are anonymous.

    Clicks of most users are moved back into the order period (one month
    per ``user_id % 12``) so first-touch attribution meets real orders.
    """
    e = "event_id"
    hour_start = add_hours("CAST(to_date(ts) AS TIMESTAMP_NTZ)", "hour(ts)")
    shift = "CASE WHEN user_id % 5 = 0 THEN 0 ELSE 24 * (8766 + 30 * (user_id % 12)) END"
    return events.selectExpr(
        f"concat('CLICK_', {pad_sql(e, 7)}) AS click_id",
        f"concat('CMP_', {pad_sql(f'({e} * 17) % {CLICKED_CAMPAIGNS} + 1', 4)}) AS campaign_id",
        f"CASE WHEN {e} % 10 < 7 THEN user_id END AS customer_id",
        f"{add_hours(hour_start, f'-({shift})')} AS clicked_at",
        f"concat('/landing/', {pick_sql(LANDING_PAGES, f'{e} % 5')}) AS source_url",
        f"{e} % 25 < 3 AS converted",
    )
