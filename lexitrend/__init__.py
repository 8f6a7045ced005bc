"""lexitrend: term-trend analytics on Spark DataFrames.

Every operator is a function from DataFrame(s) to a DataFrame built from
Spark SQL functions, joins, windows and Structured Streaming.
"""

__version__ = "0.1.0"
