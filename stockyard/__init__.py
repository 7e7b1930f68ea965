"""Warehouse-operations analytics and training-data operators on Spark DataFrames."""
