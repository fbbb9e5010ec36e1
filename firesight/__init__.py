"""Spark-native sensor analytics: enrichment, baselines, serving queries and streams."""
