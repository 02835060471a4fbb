"""All registered queries of the forecast operators."""

from __future__ import annotations

from ..ship import shipped
from . import grids, messages, streamed  # noqa: F401  they register their queries
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return {name: shipped(f) for name, f in QUERIES.items()}


def oracle_sql() -> dict:
    return dict(ORACLES)
