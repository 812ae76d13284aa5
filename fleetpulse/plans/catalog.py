"""All registered queries."""

from __future__ import annotations

from fleetpulse.plans import collections, fleet, streams  # noqa: F401
from fleetpulse.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
