"""Weighted-tag profiling and content recommendation as Spark DataFrame plans."""
