"""Queries over the driver's test tables."""

from __future__ import annotations

import importlib

_MODULES = ["exploration", "cleaning", "enrichment", "storage", "streams", "learning"]


def catalog():
    from workload.registry import QUERIES

    for name in _MODULES:
        importlib.import_module(f"workload.{name}")
    return QUERIES
