"""Imports every plan module so that all queries are registered."""

from __future__ import annotations

from . import joins_audit, mutation_io, relational, sharding, streams, windows_metrics  # noqa: F401
from .registry import QUERIES


def all_queries():
    return dict(QUERIES)
