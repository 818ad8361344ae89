"""The full query catalogue: imports every query module so it registers."""

from __future__ import annotations

from . import batch, features, sketched, streams  # noqa: F401  (they register their queries)
from .registry import REGISTRY


def queries():
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
