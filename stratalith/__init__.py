"""Layered batch analytics on stock Spark: raw -> clean -> reporting."""

__version__ = "0.1.0"
