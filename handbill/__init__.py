"""Spark-native curation of event listings."""
