"""Incremental ingestion: the deterministic daily batch, its idempotent
append, and the same append run as a file-source Structured Streaming job."""
