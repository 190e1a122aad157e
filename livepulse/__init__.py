"""livepulse: Spark-native analytics over polled live-broadcast snapshots.

Every operator is a function from DataFrames to a DataFrame, parameterised by
column names, so the same code runs in batch and in Structured Streaming.
"""

__version__ = "0.1.0"
