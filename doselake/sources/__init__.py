"""Readers: landed API pages, month-partitioned Parquet, the legacy table."""
