"""The checked queries, grouped like the operators they exercise."""

from __future__ import annotations

import importlib
from types import ModuleType

MODULES = ["text", "models", "tables", "features", "extract", "vectors", "jobs"]


def load_all() -> ModuleType:
    for name in MODULES:
        importlib.import_module(f"workload.{name}")
    return importlib.import_module("workload.registry")
