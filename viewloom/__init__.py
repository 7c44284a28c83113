"""Multi-view recording analytics on Spark DataFrames."""
