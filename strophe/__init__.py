"""Segmented-text analytics as Spark DataFrame operators."""
