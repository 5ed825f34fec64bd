"""Registered queries: each operator run on the provided tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

from wattspan.plans.queries.base import ORACLES, QUERIES
from wattspan.plans.queries import cleaning, features, monitoring, profiles, series, statistics, training  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
