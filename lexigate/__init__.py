"""Spark jobs for the data lifecycle of a text classifier."""

__version__ = "0.1.0"
