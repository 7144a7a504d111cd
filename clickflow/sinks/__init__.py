"""Where results go: Parquet folders, catalog tables and databases."""
