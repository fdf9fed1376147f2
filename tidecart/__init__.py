"""Spark-native preparation and profiling of messy retail tables."""
