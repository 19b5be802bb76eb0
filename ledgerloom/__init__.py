"""Retail analytics as Spark DataFrame operators."""
