"""Spark-native analytics for clinical-style observation tables and streams."""
