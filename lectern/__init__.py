"""Lectern: a PySpark-native analytics engine for traceable text corpora."""
