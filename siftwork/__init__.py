"""Entity vetting and screening on Spark DataFrames."""
