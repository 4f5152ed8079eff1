"""Document matching and ranking on Spark DataFrames."""
