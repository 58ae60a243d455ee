"""subtide: subscription revenue analytics on Spark DataFrames."""
