"""Whole flows: files to Parquet, Parquet to tables, tables to bronze and silver."""
