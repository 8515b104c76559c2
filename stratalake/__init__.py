"""Medallion-style analytics on Spark: land, check, clean, join, aggregate.

Operators are plain functions from DataFrames and column names to DataFrames.
"""
