"""Preference-data work on Spark DataFrames."""
