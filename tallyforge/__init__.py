"""Tallyforge: composable PySpark operators for log, catalogue, text, graph and feed analytics.

Every operator takes DataFrames and returns a DataFrame.  Nothing here runs a Python UDF;
all per-row work stays in built-in Spark expressions.
"""

__version__ = "0.1.0"
