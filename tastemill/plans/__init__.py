"""Queries over the test tables, one module per family of operators."""

from __future__ import annotations

import importlib

from tastemill.plans.registry import REGISTRY, Entry

FAMILIES = (
    "scans",
    "cleaning",
    "joins",
    "aggregations",
    "windows",
    "sets",
    "scalars",
    "features",
    "sequences",
    "similarity",
    "factors",
    "content",
    "graph",
    "retrieval",
    "learning",
    "metrics",
    "losses",
)


def load() -> dict[str, Entry]:
    """All registered queries, in the order of the families."""
    for family in FAMILIES:
        importlib.import_module(f"tastemill.plans.{family}")
    return REGISTRY
