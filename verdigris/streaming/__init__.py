"""Structured Streaming forms of ingestion, cleansing and the hourly roll-up."""
