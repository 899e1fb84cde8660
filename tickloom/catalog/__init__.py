"""Registered queries and the SQL each is checked against."""

import importlib

SECTIONS = ("features", "indicators", "frames", "quality", "text", "returns", "monitoring", "alerts", "sources", "streaming", "chains")


def load():
    """Import every section and return the registry."""
    for section in SECTIONS:
        importlib.import_module(f"tickloom.catalog.{section}")
    return importlib.import_module("tickloom.catalog.registry")
