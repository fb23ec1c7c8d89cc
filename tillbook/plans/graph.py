"""The model graph: which model is built from which inputs.

``Project.table(name)`` returns the lazily built DataFrame of a model and
memoises it, so every consumer of, say, ``int_customer_lifetime`` shares
one logical sub-plan (Catalyst then reuses its exchanges inside a query).
``Project.use(name, df)`` swaps a model for a materialised copy — the
pipeline does this for the reused intermediates and for the core marts the
reports read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillbook.config import DEFAULT_AS_OF
from tillbook.operators import core, intermediate, reports, staging
from tillbook.sources.raw import (
    derive_raw_marketing_campaigns,
    derive_raw_marketing_clicks,
    derive_raw_payments,
    derive_raw_shipments,
)
from tillbook.sources.schemas import SOURCE_SCHEMAS
from tillbook.sources.tables import read_source

_Builder = Callable[["Project"], DataFrame]

#: Staging views: function, table that it reads, whether it takes the clock.
_VIEWS = {
    "stg_customers": (staging.stg_customers, "customer", False),
    "stg_orders": (staging.stg_orders, "orders", False),
    "stg_order_items": (staging.stg_order_items, "lineitem", False),
    "stg_products": (staging.stg_products, "part", False),
    "stg_payments": (staging.stg_payments, "raw_payments", True),
    "stg_shipments": (staging.stg_shipments, "raw_shipments", False),
    "stg_marketing_campaigns": (staging.stg_marketing_campaigns, "raw_marketing_campaigns", True),
    "stg_marketing_clicks": (staging.stg_marketing_clicks, "raw_marketing_clicks", False),
}
STAGED_FROM = {view: source for view, (_, source, _) in _VIEWS.items()}


def _staged(p: Project, view: str) -> DataFrame:
    build, source, clock = _VIEWS[view]
    return build(p.table(source), *([p.as_of_sql] if clock else []))


_BUILDERS: dict[str, _Builder] = {
    # raw inputs
    "raw_payments": lambda p: p.raw["raw_payments"],
    "raw_shipments": lambda p: p.raw["raw_shipments"],
    "raw_marketing_campaigns": lambda p: p.raw["raw_marketing_campaigns"],
    "raw_marketing_clicks": lambda p: p.raw["raw_marketing_clicks"],
    # staging (views)
    **{view: (lambda p, v=view: _staged(p, v)) for view in _VIEWS},
    # intermediate (ephemeral in the warehouse; materialised once per pipeline run here)
    "int_orders_enriched": lambda p: intermediate.int_orders_enriched(
        p.table("stg_orders"), p.table("stg_order_items"), p.table("stg_payments"), p.table("stg_shipments")
    ),
    "int_customer_lifetime": lambda p: intermediate.int_customer_lifetime(
        p.table("stg_customers"), p.table("int_orders_enriched"), p.table("stg_marketing_clicks"), p.as_of_sql
    ),
    "int_product_performance": lambda p: intermediate.int_product_performance(
        p.table("stg_products"), p.table("stg_order_items")
    ),
    # core marts
    "dim_customers": lambda p: core.dim_customers(p.table("int_customer_lifetime"), p.as_of_sql),
    "dim_products": lambda p: core.dim_products(p.table("int_product_performance"), p.as_of_sql),
    "fct_orders": lambda p: core.fct_orders(p.table("int_orders_enriched"), p.as_of_sql),
    "fct_revenue": lambda p: core.fct_revenue(p.table("paid_orders"), p.table("int_customer_lifetime"), p.as_of_sql),
    # reports
    "rpt_daily_revenue": lambda p: reports.rpt_daily_revenue(p.revenue()),
    "rpt_customer_ltv": lambda p: reports.rpt_customer_ltv(p.table("dim_customers")),
    "rpt_marketing_roi": lambda p: reports.rpt_marketing_roi(
        p.table("stg_marketing_campaigns"), p.table("stg_marketing_clicks"), p.table("int_customer_lifetime")
    ),
    "rpt_funnel": lambda p: reports.rpt_funnel(
        p.table("stg_marketing_campaigns"), p.table("stg_marketing_clicks"), p.table("int_customer_lifetime")
    ),
    "rpt_executive_summary": lambda p: reports.rpt_executive_summary(
        p.revenue(), p.table("fct_orders"), p.table("int_customer_lifetime")
    ),
}

MODEL_NAMES = tuple(_BUILDERS)

#: Shared sub-plans that are no models.
_SHARED: dict[str, _Builder] = {
    "paid_orders": lambda p: core.paid_orders(p.table("stg_payments"), p.table("stg_orders")),
}
STAGING = tuple(n for n in MODEL_NAMES if n.startswith("stg_"))
INTERMEDIATE = ("int_orders_enriched", "int_customer_lifetime", "int_product_performance")
CORE = ("dim_customers", "dim_products", "fct_orders", "fct_revenue")
REPORTS = tuple(n for n in MODEL_NAMES if n.startswith("rpt_"))


class _LazyTables(dict):
    """A mapping whose values are built on first access (a scan or a derivation
    is only set up if some model actually reads it)."""

    def __init__(self, factories: dict[str, Callable[[], DataFrame]]) -> None:
        super().__init__()
        self._factories = factories

    def __missing__(self, name: str) -> DataFrame:
        df = self._factories[name]()
        self[name] = df
        return df

    def __contains__(self, name: object) -> bool:
        return name in self._factories or dict.__contains__(self, name)


class Project:
    """All models over one set of source tables and one reference clock."""

    def __init__(
        self,
        spark: SparkSession,
        sources: dict[str, DataFrame],
        raw: dict[str, DataFrame] | None = None,
        as_of: str = DEFAULT_AS_OF,
    ) -> None:
        self.spark = spark
        self.sources = sources
        if raw is None:
            raw = _LazyTables(
                {
                    "raw_payments": lambda: derive_raw_payments(sources["orders"]),
                    "raw_shipments": lambda: derive_raw_shipments(sources["orders"]),
                    "raw_marketing_campaigns": lambda: derive_raw_marketing_campaigns(sources["part"]),
                    "raw_marketing_clicks": lambda: derive_raw_marketing_clicks(sources["events"]),
                }
            )
        self.raw = raw
        # validated: the clock is embedded in SQL expressions
        as_of = dt.datetime.fromisoformat(as_of).strftime("%Y-%m-%d %H:%M:%S")
        self.as_of_text = as_of
        self.as_of_sql = f"CAST('{as_of}' AS TIMESTAMP_NTZ)"
        self._tables: dict[str, DataFrame] = {}
        self._written: set[str] = set()

    @classmethod
    def from_dir(cls, spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> Project:
        sources = _LazyTables(
            {name: (lambda n=name: read_source(spark, sf_dir, n)) for name in SOURCE_SCHEMAS}
        )
        return cls(spark, sources, as_of=as_of)

    def beside_source(self, name: str) -> DataFrame | None:
        """A staging view's columns beside those of the table it reads
        (``staging.beside_source``); None if either was replaced by another DataFrame."""
        build, source, clock = _VIEWS[name]
        if {name, source} & self._written:
            return None
        return build(self.table(source), *([self.as_of_sql] if clock else []), stage=staging.beside_source)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            if name not in _BUILDERS and name in self.sources:
                return self.sources[name]
            self._tables[name] = (_BUILDERS.get(name) or _SHARED[name])(self)
        return self._tables[name]

    def revenue(self) -> DataFrame:
        """What reports read of the revenue fact: the written mart, or else
        the payment-order join below it, without the customer segments that no report reads."""
        return self.table("fct_revenue" if "fct_revenue" in self._written else "paid_orders")

    def use(self, name: str, df: DataFrame) -> None:
        """Replace a model by a materialised copy for all later consumers."""
        self._tables[name] = df
        self._written.add(name)
        self._tables.pop("paid_orders", None)
        for later in MODEL_NAMES[MODEL_NAMES.index(name) + 1 :]:
            self._tables.pop(later, None)
            self._written.discard(later)

    def materialize(self, *names: str) -> None:
        """Pin models that many consumers read: written once to the shared
        storage folder and read back, so each is computed once and its lineage
        is cut (an executor loss re-reads files instead of recomputing upstream)."""
        from tillbook.session import pin

        for name in names:
            self.use(name, pin(self.table(name), f"pinned-{name}"))

    def register_views(self, names: tuple[str, ...] = STAGING) -> None:
        """Expose models as temp views (the staging layer is a set of views)."""
        for name in names:
            self.table(name).createOrReplaceTempView(name)
