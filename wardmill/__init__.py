"""Spark-native annotation and preparation of clinical note collections."""

__version__ = "0.1.0"
