"""All registered queries."""

from __future__ import annotations

import importlib

from bankweave.plans import registry

MODULES = ("reports", "ingest", "stores", "streams", "models", "upkeep")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"bankweave.plans.{name}")


def queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
