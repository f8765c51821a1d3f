"""Spark-native quality, repair and governance engine for robot-demonstration episodes."""

__version__ = "0.1.0"
