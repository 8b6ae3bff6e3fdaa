"""Whole runs, and the queries over the driver tables."""
