"""Scans and sinks (CSV/Parquet), nested ranking JSON and stored HTML pages as DataFrames."""
