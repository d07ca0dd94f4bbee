"""Spark-native record linkage: matchers, cascades, sampling and review merging."""
