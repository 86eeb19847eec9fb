"""Spark-native analytics over attributed spatial networks."""
