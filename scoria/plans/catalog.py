"""All registered queries (importing the modules fills the registry)."""

from __future__ import annotations

from scoria.plans import q_mart  # noqa: F401
from scoria.plans import q_metrics  # noqa: F401
from scoria.plans import q_woe  # noqa: F401
from scoria.plans import q_model  # noqa: F401
from scoria.plans import q_report  # noqa: F401
from scoria.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
