"""Sources: CSV, parquet, partitioned parquet, whole text, JSON paths, keyword dictionary."""
