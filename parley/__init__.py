"""Spark-first conversation analytics."""
