"""All registered queries and the SQL each one is checked against."""

from __future__ import annotations

from importlib import import_module

MODULES = ("clean_queries", "warehouse_queries", "market_queries", "topic_queries", "serving_queries", "layer_queries", "language_queries")


def _all(attribute: str) -> dict:
    out = {}
    for name in MODULES:
        out.update(getattr(import_module(f"newsloom.plans.{name}"), attribute))
    return out


def queries() -> dict:
    return _all("QUERIES")


def oracles() -> dict[str, str]:
    return _all("ORACLES")
