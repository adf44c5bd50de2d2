"""tidemark: point-in-time analytics on Spark DataFrames.

Every public operator is a plain function ``DataFrame -> DataFrame`` built from
native Spark expressions, joins, windows and Structured Streaming.
"""
