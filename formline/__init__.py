"""formline: entity time-series features, checks, profiling and evaluation on Spark DataFrames."""
