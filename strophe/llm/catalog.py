"""All queries of this subpackage."""

from __future__ import annotations

from .base import ORACLES, QUERIES
from . import html, licences, linefield, minhash, mixing, neighbours, pieces, prefixes, quality, spelling, suffixes, tokens, units  # noqa: F401  (modules register their queries)

__all__ = ["ORACLES", "QUERIES"]
