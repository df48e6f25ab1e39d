"""Scans: parquet tables, JDBC sources, and the fixture mapping of the driver tables."""
