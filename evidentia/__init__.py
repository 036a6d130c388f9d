"""Spark-first engine that turns document collections into checked evidence tables."""
