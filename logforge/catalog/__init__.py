"""All registered queries."""

from logforge.catalog import batches, events, framing, metrics, mixed, records  # noqa: F401
from logforge.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
