"""Spark-native operators for layered (raw -> refined -> aggregated) tables."""
