"""Named queries over the driver's tables, each with an equivalent SQL text where SQL can express it."""

from __future__ import annotations

from .base import ORACLES, QUERIES
from . import rows, texts, groups, samples, terms, metrics, flows, lexicons, models  # noqa: F401  (they register themselves)

__all__ = ["ORACLES", "QUERIES"]
