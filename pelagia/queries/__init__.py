"""Queries of the library on the driver tables."""

from __future__ import annotations


def load():
    """All registered queries by name."""
    from . import climate, effort, evaluation, governance, lookups, outlook, scoring, streams, textual  # noqa: F401
    from .registry import REGISTRY
    return REGISTRY
