"""Registered queries: each operator over the shared tables, next to the SQL that checks it."""

import importlib
import pkgutil


def load_all() -> None:
    for module in pkgutil.iter_modules(__path__):
        if module.name.startswith("q_"):
            importlib.import_module(f"{__name__}.{module.name}")
