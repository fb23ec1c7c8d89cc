"""Hand-written micro-fixtures: tiny source and raw tables built from dicts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tillbook.plans.graph import Project
from tillbook.sources.schemas import RAW_SCHEMAS, SOURCE_SCHEMAS

AS_OF = "2001-08-01 00:00:00"


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def frame(spark: SparkSession, schema, rows: list[dict]) -> DataFrame:
    names = schema.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def project(spark: SparkSession, **tables: list[dict]) -> Project:
    sources = {name: frame(spark, schema, tables.get(name, [])) for name, schema in SOURCE_SCHEMAS.items()}
    raw = {name: frame(spark, schema, tables.get(name, [])) for name, schema in RAW_SCHEMAS.items()}
    return Project(spark, sources, raw=raw, as_of=AS_OF)


_NAMED = object()


def customer(key, segment="BUILDING", name=_NAMED):
    return {"c_custkey": key, "c_name": f"Customer#{key}" if name is _NAMED else name, "c_nationkey": 1, "c_acctbal": 10.0,
            "c_mktsegment": segment}


def order(key, cust, date="2001-01-01 00:00:00", status="F", priority="1-URGENT", price=100.0):
    return {"o_orderkey": key, "o_custkey": cust, "o_orderstatus": status, "o_totalprice": price,
            "o_orderdate": ts(date), "o_orderpriority": priority}


def line(order_key, part, number=1, qty=1.0, price=10.0, discount=0.0, tax=0.0, flag="N", status="F"):
    return {"l_orderkey": order_key, "l_partkey": part, "l_suppkey": 1, "l_linenumber": number,
            "l_quantity": qty, "l_extendedprice": price, "l_discount": discount, "l_tax": tax,
            "l_returnflag": flag, "l_linestatus": status, "l_shipdate": ts("2001-01-02 00:00:00")}


def part(key, ptype="ECONOMY", name="thing"):
    return {"p_partkey": key, "p_name": name, "p_brand": "Brand#1", "p_type": ptype, "p_size": 1,
            "p_retailprice": 1.0}


def payment(pid, order_key, cust=1, amount=10.0, status="captured", paid="2001-02-01 00:00:00", method="ach"):
    return {"payment_id": pid, "order_id": order_key, "customer_id": cust, "amount_usd": money(amount),
            "payment_method": method, "status": status, "paid_at": ts(paid)}


def shipment(sid, order_key, status="delivered", shipped="2001-01-03 23:00:00", delivered="2001-01-04 01:00:00"):
    return {"shipment_id": sid, "order_id": order_key, "carrier": "UPS", "tracking_number": "TR1",
            "status": status, "shipped_at": ts(shipped), "delivered_at": ts(delivered) if delivered else None}


def campaign(cid, channel="email", ctype="acquisition", budget=1000, start="2001-01-01 00:00:00",
             end="2001-12-31 00:00:00"):
    return {"campaign_id": cid, "campaign_name": f" {cid} ", "channel": channel, "campaign_type": ctype,
            "budget_usd": budget, "started_at": ts(start), "ended_at": ts(end)}


def click(cid, campaign_id, cust, at="2001-01-01 10:00:00", converted=False):
    return {"click_id": cid, "campaign_id": campaign_id, "customer_id": cust, "clicked_at": ts(at),
            "source_url": "/landing/holiday", "converted": converted}


def rows_by(df: DataFrame, key: str) -> dict:
    return {r[key]: r.asDict() for r in df.collect()}
