"""Spark-native warehouse and data-quality engine for monthly trip-record feeds."""
