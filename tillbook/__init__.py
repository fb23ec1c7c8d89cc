"""tillbook — a commerce star schema and its reports, built as Spark jobs.

Layers follow the warehouse convention: typed staging DataFrames over the
source tables, order/customer/product intermediates, core dimensions and
facts, and five reports.  Every model is a plain function from input
DataFrames to an output DataFrame; :mod:`tillbook.plans.graph` wires them.
"""

__version__ = "0.1.0"
