"""Queries over the driver's Parquet tables and the same results in plain SQL."""
