"""Workforce analytics as Spark DataFrame transformations."""
