"""All proof queries."""

from __future__ import annotations

from proof import customers, documents, integrity, modelling, retention, sources, statistics  # noqa: F401
from proof.base import ORACLES, QUERIES, build

__all__ = ["ORACLES", "QUERIES", "build"]
