"""Sustainable-investment analytics as PySpark DataFrame operators."""
