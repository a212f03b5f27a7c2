"""Ranked-chart history analytics on Spark DataFrames."""
