"""All registered queries and their SQL."""

from __future__ import annotations

from adflow.plans import files, filters, lookups, models, ordering, pricing, rollups, scalars, streams  # noqa: F401
from adflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
