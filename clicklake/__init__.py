"""Clickstream and page-view analytics as plain PySpark DataFrame functions."""
