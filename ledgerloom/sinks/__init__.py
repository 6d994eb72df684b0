"""Sinks: partitioned/flat parquet, sorted CSV, JDBC."""
