"""Spark-native analytics over quote/trade event streams."""

__version__ = "0.3.0"
