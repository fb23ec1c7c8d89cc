"""Source tables: declared schemas, readers and derived raw event tables."""

from tillbook.sources.raw import (
    derive_raw_marketing_campaigns,
    derive_raw_marketing_clicks,
    derive_raw_payments,
    derive_raw_shipments,
)
from tillbook.sources.tables import read_raw_tables, read_source, read_sources

__all__ = [
    "derive_raw_marketing_campaigns",
    "derive_raw_marketing_clicks",
    "derive_raw_payments",
    "derive_raw_shipments",
    "read_raw_tables",
    "read_source",
    "read_sources",
]
