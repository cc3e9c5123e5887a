"""Spark-native analytics for transactions pooled from several banks."""

__version__ = "0.1.0"
