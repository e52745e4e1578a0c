"""Reading and writing: CSV, Parquet tables, order messages and the star-schema test tables."""
