"""Writers: CSV, Parquet, text lists, catalog tables and views."""
