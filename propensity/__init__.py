"""Propensity analytics on Spark DataFrames.

Every operator is a plain function from DataFrames to DataFrames. Rows are aligned
by key, never by position, and the work stays in built-in Spark expressions.
"""

__version__ = "0.1.0"
