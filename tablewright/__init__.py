"""Spark-native operators for building, loading and reconciling tables."""
