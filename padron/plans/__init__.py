"""All registered queries. Importing this package's modules fills the catalog."""

from __future__ import annotations

import importlib

MODULES = ("relational", "cleaning", "changes_io", "pages", "streams")


def load():
    """(queries, oracles) of all modules."""
    from padron.plans import catalog

    for name in MODULES:
        importlib.import_module(f"padron.plans.{name}")
    return dict(catalog.QUERIES), dict(catalog.ORACLES)
