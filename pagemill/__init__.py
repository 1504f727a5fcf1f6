"""pagemill: document structuring and analytics on Spark DataFrames."""
