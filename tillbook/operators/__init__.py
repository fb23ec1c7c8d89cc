"""Model operators: staging, intermediate, core marts, reports, data quality."""
