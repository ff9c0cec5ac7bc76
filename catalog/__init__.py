"""Registered queries: every operator bound to the given tables, with its SQL twin."""

import importlib

MODULES = ("series", "segment", "metrics", "spatial", "validation", "quality", "pairs", "warehouse", "sources", "filters")


def load_all():
    """Import every query module that exists and return the registry."""
    from catalog.registry import QUERIES

    for module in MODULES:
        importlib.import_module(f"catalog.{module}")
    return QUERIES
