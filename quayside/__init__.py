"""Versioned commodity-price analytics on Spark.

Every operator is a function from DataFrames to DataFrames. Nothing here keeps state of its own:
tables live in files that Spark writes, and each dataset version is a set of write-once folders.
"""

__version__ = "0.1.0"
