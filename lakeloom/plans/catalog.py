"""All registered queries."""

from lakeloom.plans import dimensional, files, loads, logs, olap, plays, relational, scalar, ssb, wrangling  # noqa: F401
from lakeloom.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
