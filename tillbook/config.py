"""Run-wide constants."""

# Reference clock used by tests and the registered queries.  Production runs
# pass the wall clock instead (see ``tillbook.plans.graph.Project``).
DEFAULT_AS_OF = "2001-08-01 00:00:00"

# Names of the driver tables the pipeline reads.
SOURCE_TABLES = ("customer", "orders", "lineitem", "part", "events")

RAW_TABLES = (
    "raw_payments",
    "raw_shipments",
    "raw_marketing_campaigns",
    "raw_marketing_clicks",
)
