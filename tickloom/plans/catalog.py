"""All registered queries (importing the modules registers them)."""

from tickloom.plans import drift, learning, objectives, profiles, streams, ticks  # noqa: F401
from tickloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
