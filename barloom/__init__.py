"""Market time-series feature engine on Spark DataFrames."""
