"""Named queries over the shared tables, each with its SQL twin where SQL can express it."""

from . import facets, folders, incremental, index, nested, rows  # noqa: F401  (registration)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
