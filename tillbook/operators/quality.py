"""Declarative data-quality checks: unique, not_null, accepted_values.

The check list mirrors the column tests declared on sources, seeds and
models (64 in all).  Evaluation is batched per table: the unique and
not_null checks of a table, and those of the staging view that reads it, are
one group-by on its key (with per-key NULL counts) plus one tiny global
aggregate, so a table is scanned once for both; a check that appears both on a
source and on a seed of the same table runs once and is reported under
both names.  A failing check never aborts the run — it is a row with
``passed = false``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.plans.graph import STAGED_FROM, Project


@dataclass(frozen=True)
class Check:
    resource_type: str  # source | seed | model
    table: str
    column: str
    test: str  # unique | not_null | accepted_values
    values: tuple[str, ...] = ()


def _u_n(resource: str, table: str, column: str) -> list[Check]:
    return [Check(resource, table, column, "unique"), Check(resource, table, column, "not_null")]


def _n(resource: str, table: str, *columns: str) -> list[Check]:
    return [Check(resource, table, c, "not_null") for c in columns]


# ---- fixed values: accepted order statuses ------------------------------------
ORDER_STATUS_VALUES = ("open", "fulfilled", "pending", "unknown")
# -------------------------------------------------------------------------------

CHECKS: list[Check] = [
    *_u_n("source", "customer", "c_custkey"),
    *_n("source", "customer", "c_name"),
    *_u_n("source", "orders", "o_orderkey"),
    *_n("source", "orders", "o_custkey", "o_orderdate"),
    *_n("source", "lineitem", "l_orderkey", "l_partkey"),
    *_u_n("source", "part", "p_partkey"),
    *_u_n("source", "raw_payments", "payment_id"),
    *_n("source", "raw_payments", "order_id"),
    *_u_n("source", "raw_shipments", "shipment_id"),
    *_n("source", "raw_shipments", "order_id"),
    *_u_n("source", "raw_marketing_campaigns", "campaign_id"),
    *_u_n("source", "raw_marketing_clicks", "click_id"),
    *_n("source", "raw_marketing_clicks", "campaign_id"),
    *_u_n("seed", "raw_payments", "payment_id"),
    *_u_n("seed", "raw_shipments", "shipment_id"),
    *_u_n("seed", "raw_marketing_campaigns", "campaign_id"),
    *_u_n("seed", "raw_marketing_clicks", "click_id"),
    *_u_n("model", "stg_customers", "customer_id"),
    *_n("model", "stg_customers", "full_name"),
    *_u_n("model", "stg_orders", "order_id"),
    *_n("model", "stg_orders", "customer_id"),
    Check("model", "stg_orders", "order_status", "accepted_values", ORDER_STATUS_VALUES),
    *_u_n("model", "stg_order_items", "order_item_id"),
    *_n("model", "stg_order_items", "order_id"),
    *_u_n("model", "stg_products", "product_id"),
    *_n("model", "stg_products", "product_name"),
    *_u_n("model", "stg_payments", "payment_id"),
    *_n("model", "stg_payments", "amount_usd"),
    *_u_n("model", "stg_shipments", "shipment_id"),
    *_u_n("model", "stg_marketing_campaigns", "campaign_id"),
    *_u_n("model", "stg_marketing_clicks", "click_id"),
    *_u_n("model", "dim_customers", "customer_id"),
    *_u_n("model", "dim_products", "product_id"),
    *_u_n("model", "fct_orders", "order_id"),
    *_u_n("model", "fct_revenue", "payment_id"),
    *_u_n("model", "rpt_daily_revenue", "paid_date"),
    *_u_n("model", "rpt_marketing_roi", "campaign_id"),
]

TESTS = ("unique", "not_null", "accepted_values")
RESULT_COLUMNS = ["resource_type", "table_name", "column_name", "test_name", "failures", "passed"]


def _labels(checks: list[Check], table: str, column: str, test: str) -> list[str]:
    return sorted({c.resource_type for c in checks if (c.table, c.column, c.test) == (table, column, test)})


def _emit(df: DataFrame, resources: list[str], table: str, column: str, test: str) -> DataFrame:
    """Attach the (resource, table, column, test) labels to a one-row failure count."""
    labels = ", ".join(f"'{r}'" for r in resources)
    return df.selectExpr(
        f"explode(array({labels})) AS resource_type",
        f"'{table}' AS table_name",
        f"'{column}' AS column_name",
        f"'{test}' AS test_name",
        "CAST(failures AS BIGINT) AS failures",
    )


def accepted_values_failures(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Number of distinct values outside the accepted list (NULL passes)."""
    listed = ", ".join(f"'{v}'" for v in values)
    return (
        df.groupBy(column)
        .agg(F.expr("count(1) AS n"))
        .where(f"NOT ({column} IN ({listed}))")
        .agg(F.expr("count(1) AS failures"))
    )


def _table_pass(df: DataFrame, key: str | None, nn_cols: list[str]) -> DataFrame:
    """All unique/not_null counts of one table in one pass, as one wide row.

    With a unique key: group by the key (map-side combined, so a hot or
    heavily duplicated key costs one row per task), carrying per-key NULL
    counts of the other columns, then one tiny global aggregate.  Without a
    key: a single global aggregate."""
    nulls = {c: f"_null_{i}" for i, c in enumerate(nn_cols)}
    if key is None:
        return df.agg(*[F.expr(f"count_if({c} IS NULL) AS {a}") for c, a in nulls.items()])
    per_key = df.groupBy(key).agg(
        F.expr("count(1) AS _n"), *[F.expr(f"count_if({c} IS NULL) AS {a}") for c, a in nulls.items()]
    )
    return per_key.agg(
        F.expr(f"count_if({key} IS NOT NULL AND _n > 1) AS _dup"),
        *[F.expr(f"CAST(coalesce(sum({a}), 0) AS BIGINT) AS {a}") for a in nulls.values()],
    )


def _report(wide: DataFrame, results: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """Rows of a wide row; results: resource, table, column, test, failure expression."""
    structs = ", ".join(
        f"named_struct('resource_type', '{resource}', 'table_name', '{table}', 'column_name', '{column}',"
        f" 'test_name', '{test}', 'failures', CAST({failures} AS BIGINT))"
        for resource, table, column, test, failures in results
    )
    return wide.selectExpr(f"inline(array({structs}))")


def _joint_pass(df: DataFrame, source: str, view: str, checks: list[Check]) -> DataFrame:
    """Unique and not_null checks of a table and of its staging view in one pass over ``staging.beside_source``.

    The view's key is the table's own key, so one group-by counts both."""
    own = [c for c in checks if c.table in (source, view)]
    key = next((c.column for c in CHECKS if c.table == view and c.test == "unique"))
    nulls: dict[tuple[str, str], str] = {}
    for c in own:
        if c.test == "not_null":
            where = f"_src.{c.column} IS NULL" if c.table == source else f"_staged AND {c.column} IS NULL"
            nulls.setdefault((c.table, c.column), where)
    aliases = {k: f"_null_{i}" for i, k in enumerate(nulls)}
    per_key = df.groupBy(key).agg(
        F.expr("count(1) AS _n"), F.expr("count_if(_staged) AS _m"), *[F.expr(f"count_if({w}) AS {aliases[k]}") for k, w in nulls.items()]
    )
    wide = per_key.agg(
        F.expr(f"count_if({key} IS NOT NULL AND _n > 1) AS _dup_source"),
        F.expr(f"count_if({key} IS NOT NULL AND _m > 1) AS _dup_view"),
        *[F.expr(f"coalesce(sum({a}), 0) AS {a}") for a in aliases.values()],
    )
    failures = {"unique": {source: "_dup_source", view: "_dup_view"}}
    return _report(
        wide,
        [
            (c.resource_type, c.table, c.column, c.test, failures["unique"][c.table] if c.test == "unique" else aliases[c.table, c.column])
            for c in own
            if c.test != "accepted_values"
        ],
    )


def run_checks(
    project: Project, tests: tuple[str, ...] = TESTS, checks: list[Check] | None = None
) -> DataFrame:
    checks = [c for c in (checks or CHECKS) if c.test in tests]
    parts: list[DataFrame] = []
    done: set[str] = set()
    for view, source in STAGED_FROM.items():
        wanted = [c for c in checks if c.table in (source, view) and c.test != "accepted_values"]
        if wanted and (df := project.beside_source(view)) is not None:
            parts.append(_joint_pass(df, source, view, wanted))
            done |= {source, view}
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table]
        df = project.table(table)
        for c in mine:
            if c.test == "accepted_values":
                parts.append(_emit(accepted_values_failures(df, c.column, c.values), [c.resource_type], table, c.column, c.test))
        if table in done:
            continue
        keys = list(dict.fromkeys(c.column for c in mine if c.test == "unique"))
        nn_cols = list(dict.fromkeys(c.column for c in mine if c.test == "not_null"))
        for i, key in enumerate(keys or [None]):
            cols = nn_cols if i == 0 else []
            if key is None and not cols:
                continue
            results = [(label, table, key, "unique", "_dup") for label in _labels(mine, table, key, "unique")] if key else []
            for j, c in enumerate(cols):
                results += [(label, table, c, "not_null", f"_null_{j}") for label in _labels(mine, table, c, "not_null")]
            parts.append(_report(_table_pass(df, key, cols), results))
    result = reduce(DataFrame.unionByName, parts)
    return result.selectExpr(*RESULT_COLUMNS[:-1], "failures = 0 AS passed")
