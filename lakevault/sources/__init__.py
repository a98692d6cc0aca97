"""Readers and sinks: CSV files, the layered parquet warehouse, the audit log."""
