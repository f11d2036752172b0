"""All registered queries."""

from tickwell.plans import analytics, live, monitoring, quality, storage, streams, versions  # noqa: F401
from tickwell.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
