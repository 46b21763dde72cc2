"""Tick features, spike models, drift tests and service objectives as Spark jobs."""

__version__ = "0.1.0"
