"""Corvina: evidence-graph analytics on Spark DataFrames."""
