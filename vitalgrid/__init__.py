"""Patient-risk analytics written with Spark DataFrames."""
