"""Medallion analytics for two-platform music catalogues, written for Spark.

Raw JSON responses land in bronze, are flattened into relational silver tables,
linked across the platforms, and published as gold dimensions and facts.
Every step is a function from DataFrames to a DataFrame.
"""
