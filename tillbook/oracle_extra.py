"""Oracle SQL for the data-quality checks and the daily batch queries."""

from __future__ import annotations

from tillbook.config import DEFAULT_AS_OF
from tillbook.operators.quality import CHECKS
from tillbook.oracle import AS_OF, BATCH_DAY, CTES, HOURS, cte, model_sql, with_ctes
from tillbook.sources.schemas import RAW_SCHEMAS

# ------------------------------------------------------------- daily batch
def _sampled(name: str, table: str, key: str, columns: str, raw: str) -> None:
    """The rows of a table in the order of the day's draw for a raw table."""
    cte(name, [], f"""
SELECT {columns}, row_number() OVER (ORDER BY md5('{DEFAULT_AS_OF[:10]}:{raw}:' || {key}), {key}) AS rn
FROM {table} WHERE {key} IS NOT NULL""")


_sampled("sampled_orders", "orders", "o_orderkey", "o_orderkey, o_custkey", "raw_payments")
_sampled("sampled_shipped", "orders", "o_orderkey", "o_orderkey", "raw_shipments")
_sampled("sampled_customers", "customer", "c_custkey", "c_custkey", "raw_marketing_clicks")

cte("batch_payments", ["sampled_orders"], f"""
SELECT 'PMT_{BATCH_DAY}_' || printf('%04d', rn) AS payment_id, o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(15 + (o_orderkey * 7919) % 4986 AS DECIMAL(12,2)) AS amount_usd,
       CASE WHEN (rn * 37) % 100 < 5 THEN NULL
            WHEN rn % 5 = 0 THEN 'credit_card' WHEN rn % 5 = 1 THEN 'debit_card' WHEN rn % 5 = 2 THEN 'ach'
            WHEN rn % 5 = 3 THEN 'paypal' ELSE 'apple_pay' END AS payment_method,
       CASE WHEN (rn * 53) % 100 < 5 THEN 'failed' WHEN (rn * 53) % 100 < 10 THEN 'pending'
            WHEN (rn * 53) % 100 < 15 THEN 'refunded' ELSE 'captured' END AS status,
       {AS_OF} - {HOURS('rn % 37')} AS paid_at
FROM sampled_orders WHERE rn <= 100""")

cte("batch_shipments", ["sampled_shipped"], f"""
SELECT 'SHIP_{BATCH_DAY}_' || printf('%04d', rn) AS shipment_id, o_orderkey AS order_id,
       CASE rn % 4 WHEN 0 THEN 'UPS' WHEN 1 THEN 'FedEx' WHEN 2 THEN 'USPS' ELSE 'DHL' END AS carrier,
       CAST(100000000 + (o_orderkey * 104729) % 899999999 AS VARCHAR) AS tracking_number,
       CASE WHEN (rn * 53) % 100 < 5 THEN 'returned' WHEN (rn * 53) % 100 < 20 THEN 'in_transit'
            WHEN (rn * 53) % 100 < 25 THEN 'delayed' ELSE 'delivered' END AS status,
       {AS_OF} - to_days(CAST(1 + rn % 7 AS INTEGER)) AS shipped_at,
       CASE WHEN (rn * 37) % 100 < 75 THEN {AS_OF} + to_days(CAST(2 + rn % 7 AS INTEGER)) END AS delivered_at
FROM sampled_shipped WHERE rn <= 75""")

cte("batch_clicks", ["sampled_customers"], f"""
SELECT 'CLICK_{BATCH_DAY}_' || printf('%05d', rn) AS click_id,
       'CMP_' || printf('%04d', (rn * 17) % 40 + 1) AS campaign_id,
       CASE WHEN (rn * 41) % 100 < 70 THEN c_custkey END AS customer_id,
       {AS_OF} - {HOURS('rn % 25')} AS clicked_at,
       '/landing/' || CASE rn % 5 WHEN 0 THEN 'summer-sale' WHEN 1 THEN 'new-arrivals' WHEN 2 THEN 'holiday'
            WHEN 3 THEN 'clearance' ELSE 'newsletter' END AS source_url,
       (rn * 59) % 100 < 12 AS converted
FROM sampled_customers WHERE rn <= 150""")

_BATCH = {
    # raw table, batch cte, key, label, prefix
    "payments": ("raw_payments", "batch_payments", "payment_id", f"PMT_{BATCH_DAY}_"),
    "shipments": ("raw_shipments", "batch_shipments", "shipment_id", f"SHIP_{BATCH_DAY}_"),
    "marketing_clicks": ("raw_marketing_clicks", "batch_clicks", "click_id", f"CLICK_{BATCH_DAY}_"),
}

# First-load rows carry no batch date; a day's batch is judged by the rows that carry its date.
DAY = f"DATE '{DEFAULT_AS_OF[:10]}'"

_guard_parts = []
for _label, (_raw, _batch, _key, _prefix) in _BATCH.items():
    cte(f"dated_{_raw}", [_raw], f"SELECT *, CAST(NULL AS DATE) AS batch_date FROM {_raw}")
    cte(
        f"guarded_{_batch}",
        [f"dated_{_raw}", _batch],
        f"SELECT *, {DAY} AS batch_date FROM {_batch} WHERE {_key} NOT IN (SELECT {_key} FROM dated_{_raw} WHERE batch_date = {DAY})",
    )
    cte(f"after_{_raw}", [f"dated_{_raw}", f"guarded_{_batch}"], f"FROM dated_{_raw} UNION ALL BY NAME FROM guarded_{_batch}")
    _guard_parts.append(
        f"SELECT '{_label}' AS table_name, '{_prefix}' AS batch_prefix, "
        f"(SELECT count(*) FROM dated_{_raw} WHERE batch_date = {DAY} AND starts_with({_key}, '{_prefix}')) AS existing_batch_rows, "
        f"(SELECT count(*) FROM {_batch}) AS batch_rows, (SELECT count(*) FROM guarded_{_batch}) AS rows_to_append"
    )

cte(
    "batch_guard",
    [dep for v in _BATCH.values() for dep in (f"dated_{v[0]}", f"guarded_{v[1]}")],
    "\nUNION ALL\n".join(_guard_parts),
)


def _appended_sql() -> str:
    parts = []
    for label, (raw, batch, key, _) in _BATCH.items():
        names = RAW_SCHEMAS[raw].names
        text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in names if c != key)
        parts.append(f"SELECT '{label}' AS table_name, {key} AS row_key, concat_ws('|', {text}) AS row_values FROM after_{raw} WHERE batch_date = {DAY}")
    return with_ctes([f"after_{v[0]}" for v in _BATCH.values()], "\nUNION ALL\n".join(parts))


cte(
    "raw_counts",
    [f"after_{v[0]}" for v in _BATCH.values()],
    "\nUNION ALL\n".join(
        f"SELECT '{label}' AS table_name, (SELECT count(*) FROM after_{raw}) AS row_count"
        for label, (raw, *_rest) in _BATCH.items()
    ),
)

_TIME = {"raw_payments": "paid_at", "raw_shipments": "shipped_at", "raw_marketing_clicks": "clicked_at"}
_ID = {"raw_payments": "PMT_", "raw_shipments": "SHIP_", "raw_marketing_clicks": "CLICK_"}
_LATEST = {"latest_payments": "raw_payments", "latest_shipments": "raw_shipments", "latest_clicks": "raw_marketing_clicks"}
_KEYS = {v[0]: v[2] for v in _BATCH.values()}


def _latest_sql(raw: str) -> str:
    key, ts = _KEYS[raw], _TIME[raw]
    return with_ctes(
        [f"after_{raw}"],
        f"SELECT * EXCLUDE (batch_date) FROM after_{raw} WHERE {key} LIKE '{_ID[raw]}%' "
        f"ORDER BY {ts} DESC NULLS LAST, {key} ASC LIMIT 5",
    )


# -------------------------------------------------------------- data quality
_SOURCE_TABLES = {"customer", "orders", "lineitem", "part"}


def _check_sql(table: str, column: str, test: str, values: tuple[str, ...]) -> str:
    if test == "unique":
        return (
            f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1) d)"
        )
    if test == "not_null":
        return f"(SELECT count(*) FROM {table} WHERE {column} IS NULL)"
    listed = ", ".join(f"'{v}'" for v in values)
    return f"(SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY {column}) d WHERE {column} NOT IN ({listed}))"


def dq_sql(tests: tuple[str, ...]) -> str:
    checks = [c for c in CHECKS if c.test in tests]
    parts = [
        f"SELECT '{c.resource_type}' AS resource_type, '{c.table}' AS table_name, '{c.column}' AS column_name, "
        f"'{c.test}' AS test_name, CAST({_check_sql(c.table, c.column, c.test, c.values)} AS BIGINT) AS failures"
        for c in checks
    ]
    needed = sorted({c.table for c in checks if c.table not in _SOURCE_TABLES and c.table in CTES})
    body = "SELECT *, failures = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) checks"
    return with_ctes(needed, body) if needed else body


def queries() -> dict[str, str]:
    out = {
        "sample_rows": with_ctes(
            ["sampled_orders"], "SELECT o_orderkey, o_custkey, CAST(rn AS INTEGER) AS rn FROM sampled_orders WHERE rn <= 100"
        ),
        "batch_payments": with_ctes(["batch_payments"], "SELECT * FROM batch_payments"),
        "batch_shipments": with_ctes(["batch_shipments"], "SELECT * FROM batch_shipments"),
        "batch_clicks": with_ctes(["batch_clicks"], "SELECT * FROM batch_clicks"),
        "batch_guard": with_ctes(["batch_guard"], "SELECT * FROM batch_guard"),
        "raw_counts": with_ctes(["raw_counts"], "SELECT * FROM raw_counts"),
        # the physical append (and its streaming form) must land exactly the guarded rows once
        "append_batch": _appended_sql(),
        "stream_append": _appended_sql(),
        # a table is the same after a rebuild over itself
        "rebuilt_table": model_sql("rpt_daily_revenue"),
        # a raw table is the same after a round through seed CSV
        "seed_payments": model_sql("raw_payments"),
        "seed_shipments": model_sql("raw_shipments"),
        "seed_campaigns": model_sql("raw_marketing_campaigns"),
        "seed_clicks": model_sql("raw_marketing_clicks"),
        "dq_unique": dq_sql(("unique",)),
        "dq_not_null": dq_sql(("not_null",)),
        "dq_accepted_values": dq_sql(("accepted_values",)),
        "dq_summary": dq_sql(("unique", "not_null", "accepted_values")),
    }
    out.update({name: _latest_sql(raw) for name, raw in _LATEST.items()})
    return out
