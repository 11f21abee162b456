"""Spectral-survey analytics as PySpark DataFrame operators."""
