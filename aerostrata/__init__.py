"""Spark-native analytics for station-based sensor readings."""
