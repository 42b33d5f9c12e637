"""Operators for large text corpora: one module per operator, its query beside it."""
