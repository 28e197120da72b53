"""Incident event pipeline on Spark: strict parsing, routing, projections, replay, summaries."""

from sirenlog.session import configure

__all__ = ["configure"]
