"""Market-structure analytics on Spark DataFrames."""
