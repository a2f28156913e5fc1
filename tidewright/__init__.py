"""Record movement and table maintenance with Spark DataFrames."""
