"""Daily track-analytics batches on Spark DataFrames."""
