"""Retail-media analytics on Spark DataFrames."""
