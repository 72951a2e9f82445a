"""Spark-native tabular preparation, profiling, feature and model-selection operators."""

__version__ = "0.1.0"
