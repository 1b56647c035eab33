"""reliq: trustworthy transaction data on Spark.

Lands untyped records, types and validates them, keeps every reject with its
reason, builds a star schema with daily metrics, and checks its own output.
"""
