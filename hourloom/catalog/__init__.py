"""The registered queries, one per operator."""

from importlib import import_module

from hourloom.catalog.base import ORACLES, QUERIES

GROUPS = ("expressions", "tables", "series", "reports", "learning", "streams")


def load():
    for group in GROUPS:
        import_module(f"hourloom.catalog.{group}")
    return QUERIES, ORACLES
