"""Spark SQL text for values, dates, numbers and comparisons."""
