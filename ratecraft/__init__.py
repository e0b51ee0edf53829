"""Rating and event analytics on Spark: DataFrames in, DataFrames out."""
