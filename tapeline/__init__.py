"""Windowed analytics over trade streams, written as PySpark DataFrame transformations."""
