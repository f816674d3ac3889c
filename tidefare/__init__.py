"""Ride-demand and surge-pricing analytics on Spark DataFrames.

Every operator is a function from DataFrame to DataFrame (or to Column), so the
same code serves batch, SQL and Structured Streaming.
"""
