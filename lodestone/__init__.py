"""Lodestone: a PySpark-native engine for citable corpora and hybrid retrieval."""
