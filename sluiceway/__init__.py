"""Declared batch work on Spark: multi-table text in, queries and named steps, checked loads out."""
