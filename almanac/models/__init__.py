"""Spark ML pipelines over the operators' output."""
