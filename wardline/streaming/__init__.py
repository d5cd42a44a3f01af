"""Incremental file ingest with Structured Streaming."""

from wardline.streaming.ingest import (
    ingest_all,
    ingest_files,
    raw_tables,
    read_raw_table,
    validate_batch,
    with_ingest_columns,
)

__all__ = [
    "ingest_all",
    "ingest_files",
    "raw_tables",
    "read_raw_table",
    "validate_batch",
    "with_ingest_columns",
]
