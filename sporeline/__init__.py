"""Spark-native engine for literature analytics."""
