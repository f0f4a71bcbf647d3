"""Scans: delimited bronze files, silver Parquet, catalogue, landing checks."""
