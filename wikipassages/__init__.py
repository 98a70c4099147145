"""Spark-native analytics over wiki dumps: sections, redirects, statistics, search."""

__version__ = "0.1.0"
