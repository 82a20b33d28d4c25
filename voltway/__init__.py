"""Session analytics on Spark DataFrames."""
