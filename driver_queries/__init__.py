"""The library's operators on the driver tables, each with equivalent SQL."""

from __future__ import annotations

import importlib

AREAS = ["warehouse", "lake", "relational", "dataquality", "storage", "vaults", "streams", "edges"]


def all_queries() -> dict:
    """Name to (query, SQL or None), over all areas."""
    merged = {}
    for area in AREAS:
        merged.update(importlib.import_module(f"driver_queries.{area}").QUERIES)
    return merged
