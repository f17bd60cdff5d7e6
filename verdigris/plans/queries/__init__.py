"""Registered queries, grouped by subject. Importing this package fills the registry."""

from verdigris.plans.queries import (  # noqa: F401
    layers,
    learning,
    reads,
    sources,
    streams,
    timeseries,
)
