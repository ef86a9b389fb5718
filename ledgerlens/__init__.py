"""Customer analytics over invoice tables, written for Spark DataFrames."""
