"""Deterministic PySpark DataFrame jobs for event counts and time series."""

__version__ = "0.1.0"
