"""Scalar column functions. Every one is a native Spark expression: no Python UDFs."""
