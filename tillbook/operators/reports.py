"""The five reports.

Every report first reduces its (large) inputs to a small grain — a day, a
month, a campaign, a (channel, type) pair, a segment pair — with partial
aggregation, and only then joins or windows.  The global windows (lag,
rolling average) run on one row per day / month, so their single-partition
exchange is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions.dates import month_start
from tillbook.functions.numeric import (
    ZERO_COUNT,
    ZERO_MONEY,
    E,
    exprs,
    flag_sum,
    mean_of,
    money_sum,
    pct,
    ratio,
    stable_round,
)
from tillbook.operators.percentile import null_safe_on, percentile_from_histogram, value_histogram

_BY_DAY = "ORDER BY paid_date ASC NULLS LAST"
_LAST_7 = f"({_BY_DAY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


def rpt_daily_revenue(revenue: DataFrame) -> DataFrame:
    daily = revenue.groupBy("paid_date").agg(
        *exprs(
            "count(1) AS payment_count",
            "count(DISTINCT order_id) AS orders_paid",
            "count(DISTINCT customer_id) AS paying_customers",
            f"{money_sum('revenue_usd')} AS revenue_usd",
            f"{mean_of('revenue_usd')} AS avg_payment",
        )
    )
    with_prev = daily.selectExpr(
        "*",
        f"lag(revenue_usd) OVER ({_BY_DAY}) AS prior",
        f"CAST(sum(revenue_usd) OVER {_LAST_7} AS DOUBLE) / CAST(count(revenue_usd) OVER {_LAST_7} AS DOUBLE)"
        " AS rolling",
    )
    return with_prev.selectExpr(
        "paid_date",
        "payment_count",
        "orders_paid",
        "paying_customers",
        "revenue_usd",
        f"{stable_round('avg_payment', 2)} AS avg_payment_usd",
        "prior AS prior_day_revenue_usd",
        "CAST(revenue_usd - prior AS DECIMAL(22,2)) AS day_over_day_change_usd",
        f"{pct('revenue_usd - prior', 'prior')} AS day_over_day_change_pct",
        f"{stable_round('rolling', 2)} AS rolling_7d_avg_usd",
    ).orderBy(F.col("paid_date").desc_nulls_first())


def rpt_customer_ltv(customers: DataFrame) -> DataFrame:
    """Segment summary with an exact median.

    One pass over the customers: a (segment pair, revenue) histogram that
    also carries the partial sums the summary needs, so the median and the
    averages come from the same combined shuffle.  Averages are
    ``double(sum) / count`` of the original columns (NULLs ignored)."""
    keys = ["lifetime_segment", "market_segment"]
    hist = value_histogram(
        customers,
        keys,
        "total_revenue_usd",
        *exprs(
            f"{flag_sum('is_active')} AS h_active",
            f"{money_sum('total_revenue_usd')} AS h_revenue",
            "count(total_revenue_usd) AS h_revenue_n",
            "sum(avg_order_value_usd) AS h_aov_sum",
            "count(avg_order_value_usd) AS h_aov_n",
            "sum(total_orders) AS h_orders_sum",
            "count(total_orders) AS h_orders_n",
            "sum(return_rate_pct) AS h_rr_sum",
            "count(return_rate_pct) AS h_rr_n",
        ),
    )
    # customers without a revenue are in the histogram too, under a NULL value
    summary = hist.groupBy(*keys).agg(
        *exprs(
            "CAST(sum(_c) AS BIGINT) AS customer_count",
            "CAST(sum(h_active) AS BIGINT) AS active_customer_count",
            f"{money_sum('h_revenue')} AS total_revenue_usd",
            f"{stable_round('CAST(sum(h_revenue) AS DOUBLE) / CAST(nullif(sum(h_revenue_n), 0) AS DOUBLE)', 2)} AS avg_ltv_usd",
            f"{stable_round('sum(h_aov_sum) / CAST(nullif(sum(h_aov_n), 0) AS DOUBLE)', 2)} AS avg_aov_usd",
            f"{stable_round('CAST(sum(h_orders_sum) AS DOUBLE) / CAST(nullif(sum(h_orders_n), 0) AS DOUBLE)', 1)}"
            " AS avg_orders_per_customer",
            f"{stable_round('sum(h_rr_sum) / CAST(nullif(sum(h_rr_n), 0) AS DOUBLE)', 2)} AS avg_return_rate_pct",
        )
    )
    median = percentile_from_histogram(hist, keys, 0.5, alias="median_raw")
    joined = summary.join(median, null_safe_on(summary, median, keys), "left")
    return joined.select(
        *[summary[k] for k in keys],
        "customer_count",
        "active_customer_count",
        "total_revenue_usd",
        "avg_ltv_usd",
        E(f"{stable_round('median_raw', 2)} AS median_ltv_usd"),
        "avg_aov_usd",
        "avg_orders_per_customer",
        "avg_return_rate_pct",
    ).orderBy(F.col("total_revenue_usd").desc_nulls_first())


def clicks_by_campaign_customer(clicks: DataFrame) -> DataFrame:
    """Clicks pre-aggregated to (campaign, customer): the shared input of the
    campaign and channel click metrics.  Distinct clickers become plain row
    counts at this grain, and a hot campaign is already combined map-side."""
    return clicks.groupBy("campaign_id", "customer_id").agg(
        *exprs("count(1) AS n_clicks", f"{flag_sum('did_convert')} AS n_conversions")
    )


def attribution_by_campaign(lifetime: DataFrame) -> DataFrame:
    """Acquired customers and their revenue per first-touch campaign.

    Each customer id has exactly one acquisition campaign, so distinct
    customers add up exactly across campaigns of a channel."""
    return (
        lifetime.where("acquisition_campaign_id IS NOT NULL")
        .groupBy(E("acquisition_campaign_id AS campaign_id"))
        .agg(
            *exprs(
                f"{money_sum('total_revenue_usd')} AS attributed_revenue_usd",
                "count(1) AS attributed_customer_count",
                "count(DISTINCT customer_id) AS attributed_distinct_customers",
            )
        )
    )


def rpt_marketing_roi(campaigns: DataFrame, clicks: DataFrame, lifetime: DataFrame) -> DataFrame:
    campaign_clicks = clicks_by_campaign_customer(clicks).groupBy("campaign_id").agg(
        *exprs(
            "CAST(sum(n_clicks) AS BIGINT) AS click_count",
            "count(customer_id) AS unique_clickers",
            "CAST(sum(n_conversions) AS BIGINT) AS conversions",
        )
    )
    joined = campaigns.join(campaign_clicks, "campaign_id", "left").join(
        attribution_by_campaign(lifetime), "campaign_id", "left"
    )
    return joined.selectExpr(
        "campaign_id",
        "campaign_name",
        "channel",
        "campaign_type",
        "budget_usd",
        "duration_days",
        f"coalesce(click_count, {ZERO_COUNT}) AS click_count",
        f"coalesce(unique_clickers, {ZERO_COUNT}) AS unique_clickers",
        f"coalesce(conversions, {ZERO_COUNT}) AS conversions",
        f"CASE WHEN click_count > 0 THEN {pct('conversions', 'click_count')} ELSE 0.0D END AS conversion_rate_pct",
        f"coalesce(attributed_customer_count, {ZERO_COUNT}) AS customers_acquired",
        f"coalesce(attributed_revenue_usd, {ZERO_MONEY}) AS attributed_revenue_usd",
        f"""CASE WHEN budget_usd > 0 AND attributed_revenue_usd IS NOT NULL
                 THEN {stable_round(ratio('attributed_revenue_usd', 'budget_usd'), 2)} END AS roi_multiplier""",
        f"""CASE WHEN budget_usd > 0 AND click_count > 0
                 THEN {stable_round(ratio('budget_usd', 'click_count'), 2)} END AS cost_per_click_usd""",
        f"""CASE WHEN attributed_customer_count > 0
                 THEN {stable_round(ratio('budget_usd', 'attributed_customer_count'), 2)} END
            AS cost_per_acquisition_usd""",
    ).orderBy(F.col("budget_usd").desc_nulls_first())


def rpt_funnel(campaigns: DataFrame, clicks: DataFrame, lifetime: DataFrame) -> DataFrame:
    keys = ["channel", "campaign_type"]
    channel_stats = campaigns.groupBy(*keys).agg(
        *exprs("count(DISTINCT campaign_id) AS campaign_count", f"{money_sum('budget_usd')} AS total_budget_usd")
    )
    # campaign -> (channel, type) with the number of dimension rows carrying
    # it, so counts stay exact even if the dimension repeats a campaign id.
    campaign_map = campaigns.groupBy("campaign_id", *keys).agg(*exprs("count(1) AS mult"))
    pairs = clicks_by_campaign_customer(clicks)
    # Both sides of this join are plain shuffles, so AQE broadcasts the map if it
    # measures small, and else splits a campaign that owns a third of the pairs.
    clicks_per_channel = (
        pairs.join(campaign_map, "campaign_id")
        .groupBy(*keys)
        .agg(
            *exprs(
                "CAST(sum(n_clicks * mult) AS BIGINT) AS c_total_clicks",
                "count(DISTINCT customer_id) AS c_unique_clickers",
                "CAST(sum(n_conversions * mult) AS BIGINT) AS c_conversions",
            )
        )
    )
    revenue_per_channel = (
        attribution_by_campaign(lifetime)
        .join(campaign_map, "campaign_id", "inner")
        .groupBy(*keys)
        .agg(
            *exprs(
                "CAST(sum(attributed_distinct_customers) AS BIGINT) AS r_paying_customers",
                f"{money_sum('attributed_revenue_usd * mult')} AS r_channel_revenue_usd",
            )
        )
    )
    # NULL channel/type never match (plain equi-join semantics).
    joined = channel_stats.join(clicks_per_channel, keys, "left").join(revenue_per_channel, keys, "left")
    out = joined.selectExpr(
        "channel",
        "campaign_type",
        "campaign_count",
        "total_budget_usd",
        f"coalesce(c_total_clicks, {ZERO_COUNT}) AS total_clicks",
        f"coalesce(c_unique_clickers, {ZERO_COUNT}) AS unique_clickers",
        f"coalesce(c_conversions, {ZERO_COUNT}) AS conversions",
        f"coalesce(r_paying_customers, {ZERO_COUNT}) AS paying_customers",
        f"coalesce(r_channel_revenue_usd, {ZERO_MONEY}) AS channel_revenue_usd",
        f"""CASE WHEN c_total_clicks > 0 THEN {pct('c_conversions', 'c_total_clicks')} ELSE 0.0D END
            AS click_to_conversion_pct""",
        # NULL (not 0) when a channel has conversions but acquired nobody
        f"""CASE WHEN c_conversions > 0 THEN {pct('r_paying_customers', 'c_conversions')} ELSE 0.0D END
            AS conversion_to_paid_pct""",
        f"""CASE WHEN total_budget_usd > 0 AND r_channel_revenue_usd IS NOT NULL
                 THEN {stable_round(ratio('r_channel_revenue_usd', 'total_budget_usd'), 2)} END AS channel_roi""",
    )
    return out.orderBy(F.col("channel_revenue_usd").desc_nulls_last())


def rpt_executive_summary(revenue: DataFrame, orders: DataFrame, lifetime: DataFrame) -> DataFrame:
    by_revenue_month = revenue.groupBy(E(f"{month_start('paid_date')} AS r_month")).agg(
        *exprs(
            f"{money_sum('revenue_usd')} AS r_revenue_usd",
            "count(DISTINCT order_id) AS r_orders_paid",
            "count(DISTINCT customer_id) AS r_paying_customers",
        )
    )
    by_order_month = orders.groupBy(E(f"{month_start('order_date')} AS o_month")).agg(
        *exprs(
            "count(1) AS o_orders_placed",
            f"{flag_sum('has_return')} AS o_orders_returned",
            f"{mean_of('days_to_delivery')} AS o_avg_delivery_days",
        )
    )
    by_acquisition_month = (
        lifetime.where("acquired_at IS NOT NULL")
        .groupBy(E(f"{month_start('acquired_at')} AS c_month"))
        .agg(*exprs("count(1) AS c_new_customers"))
    )
    r_month, o_month, c_month = F.col("r_month"), F.col("o_month"), F.col("c_month")
    joined = by_revenue_month.join(by_order_month, r_month == o_month, "full").join(
        by_acquisition_month, F.coalesce(r_month, o_month) == c_month, "full"
    )
    prev = "lag(r_revenue_usd) OVER (ORDER BY r_month ASC NULLS LAST)"
    return joined.selectExpr(
        "coalesce(r_month, o_month, c_month) AS report_month",
        f"coalesce(r_revenue_usd, {ZERO_MONEY}) AS revenue_usd",
        f"coalesce(r_orders_paid, {ZERO_COUNT}) AS orders_paid",
        f"coalesce(o_orders_placed, {ZERO_COUNT}) AS orders_placed",
        f"coalesce(o_orders_returned, {ZERO_COUNT}) AS orders_returned",
        f"""CASE WHEN o_orders_placed > 0 THEN {pct('o_orders_returned', 'o_orders_placed')} ELSE 0.0D END
            AS return_rate_pct""",
        f"coalesce(r_paying_customers, {ZERO_COUNT}) AS paying_customers",
        f"coalesce(c_new_customers, {ZERO_COUNT}) AS new_customers",
        f"{stable_round('o_avg_delivery_days', 1)} AS avg_delivery_days",
        f"{pct(f'r_revenue_usd - {prev}', prev)} AS revenue_mom_change_pct",
    ).orderBy(F.col("report_month").desc_nulls_first())
