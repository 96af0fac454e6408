"""Spark-native engine for turning papers and long documents into searchable tables."""
