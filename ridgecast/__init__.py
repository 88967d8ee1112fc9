"""Spark-native terrain coverage analytics."""
