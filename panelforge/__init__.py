"""Demand-panel analytics on Spark DataFrames."""
