"""All queries of the library: importing this module registers them."""

from __future__ import annotations

from . import eligibility, exchange, listings, marts, pipeline, reporting, values  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
