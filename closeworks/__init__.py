"""Closing-book operators for Spark: monthly legal and finance tables as DataFrames."""

__version__ = "0.1.0"
