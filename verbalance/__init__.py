"""Transcript intake and reconciliation as Spark jobs."""

__version__ = "0.1.0"
