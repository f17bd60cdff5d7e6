"""Relational, time-series and machine-learning operators over DataFrames."""
