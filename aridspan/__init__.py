"""Spark-first analytics over daily gridded climate data."""
