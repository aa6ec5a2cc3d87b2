"""Extractive text summarisation analytics on Spark DataFrames."""
