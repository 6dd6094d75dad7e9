"""Spark-native entity resolution for place records, and operators for text corpora."""
