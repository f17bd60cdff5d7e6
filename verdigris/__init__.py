"""Verdigris: sensor analytics expressed as Spark DataFrame jobs."""
