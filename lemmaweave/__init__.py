"""Spark-first engine for cross-referencing document collections."""
