"""Leakage-safe feature engineering on Spark DataFrames."""
