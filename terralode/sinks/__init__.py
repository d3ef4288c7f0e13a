"""Writers: DataFrames to Parquet files and tables."""
