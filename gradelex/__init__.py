"""Spark-native engine for graded, multilingual vocabulary lists."""
