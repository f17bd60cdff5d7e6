"""Scans, sinks, publishing, routing and replay packing."""
