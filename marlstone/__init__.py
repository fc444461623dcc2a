"""Marlstone: a PySpark-native engine for market-data quality and analytics."""

__version__ = "0.1.0"
