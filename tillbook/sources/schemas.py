"""Declared schemas of the source and raw tables.

The source schemas list every column the staging layer selects.  The columns
in ``OPTIONAL`` may be absent from a deployment's tables (the test tables have
no addresses, comments, clerks, commit/receipt dates, …) and are then typed
NULLs; any other missing column is an error.  Amounts declared double may be
stored as decimals.
"""

from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_TS, _DATE, _B = T.TimestampNTZType(), T.DateType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


CUSTOMER = _struct(
    ("c_custkey", _L),
    ("c_name", _S),
    ("c_address", _S),
    ("c_nationkey", _I),
    ("c_phone", _S),
    ("c_acctbal", _D),
    ("c_mktsegment", _S),
    ("c_comment", _S),
)

ORDERS = _struct(
    ("o_orderkey", _L),
    ("o_custkey", _L),
    ("o_orderstatus", _S),
    ("o_totalprice", _D),
    ("o_orderdate", _TS),
    ("o_orderpriority", _S),
    ("o_clerk", _S),
    ("o_shippriority", _I),
)

LINEITEM = _struct(
    ("l_orderkey", _L),
    ("l_partkey", _L),
    ("l_suppkey", _L),
    ("l_linenumber", _I),
    ("l_quantity", _D),
    ("l_extendedprice", _D),
    ("l_discount", _D),
    ("l_tax", _D),
    ("l_returnflag", _S),
    ("l_linestatus", _S),
    ("l_shipdate", _TS),
    ("l_commitdate", _DATE),
    ("l_receiptdate", _DATE),
)

PART = _struct(
    ("p_partkey", _L),
    ("p_name", _S),
    ("p_mfgr", _S),
    ("p_brand", _S),
    ("p_type", _S),
    ("p_size", _I),
    ("p_container", _S),
    ("p_retailprice", _D),
    ("p_comment", _S),
)

EVENTS = _struct(
    ("event_id", _L),
    ("ts", _TS),
    ("user_id", _L),
    ("event_type", _S),
    ("value", _D),
    ("props", _S),
)

RAW_PAYMENTS = _struct(
    ("payment_id", _S),
    ("order_id", _L),
    ("customer_id", _L),
    ("amount_usd", T.DecimalType(12, 2)),
    ("payment_method", _S),
    ("status", _S),
    ("paid_at", _TS),
)

RAW_SHIPMENTS = _struct(
    ("shipment_id", _S),
    ("order_id", _L),
    ("carrier", _S),
    ("tracking_number", _S),
    ("status", _S),
    ("shipped_at", _TS),
    ("delivered_at", _TS),
)

RAW_MARKETING_CAMPAIGNS = _struct(
    ("campaign_id", _S),
    ("campaign_name", _S),
    ("channel", _S),
    ("campaign_type", _S),
    ("budget_usd", _L),
    ("started_at", _TS),
    ("ended_at", _TS),
)

RAW_MARKETING_CLICKS = _struct(
    ("click_id", _S),
    ("campaign_id", _S),
    ("customer_id", _L),
    ("clicked_at", _TS),
    ("source_url", _S),
    ("converted", _B),
)

SOURCE_SCHEMAS = {
    "customer": CUSTOMER,
    "orders": ORDERS,
    "lineitem": LINEITEM,
    "part": PART,
    "events": EVENTS,
}

OPTIONAL = {
    "customer": {"c_address", "c_phone", "c_comment"},
    "orders": {"o_clerk", "o_shippriority"},
    "lineitem": {"l_commitdate", "l_receiptdate"},
    "part": {"p_mfgr", "p_container", "p_comment"},
    "events": {"value", "props"},
}

RAW_SCHEMAS = {
    "raw_payments": RAW_PAYMENTS,
    "raw_shipments": RAW_SHIPMENTS,
    "raw_marketing_campaigns": RAW_MARKETING_CAMPAIGNS,
    "raw_marketing_clicks": RAW_MARKETING_CLICKS,
}
