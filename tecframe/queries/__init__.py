"""Registered queries over the given tables, each with its SQL counterpart."""

from tecframe.queries import (  # noqa: F401
    aggregation, composed, filters, geometry, matching, scalars, storage, swath, tracks,
)
from tecframe.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
