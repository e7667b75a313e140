"""All registered queries."""

from __future__ import annotations

from . import detectors, ingest, logsearch, profiles, streams, timeseries  # noqa: F401  (they register)
from .registry import ORACLES, QUERIES

FLAGSHIP = "tumbling_mean_by_split"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
