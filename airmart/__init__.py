"""Hourly weather and air-quality analytics built on Spark DataFrames."""
