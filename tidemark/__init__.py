"""Spark-native analytics over censored measurements, lineages and maps."""
