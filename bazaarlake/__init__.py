"""Retail warehouse and analytics on Spark DataFrames."""
