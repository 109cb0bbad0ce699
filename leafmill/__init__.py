"""Leafmill: document analytics on Spark DataFrames."""
