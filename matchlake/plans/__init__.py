"""Plans: the match star, the marts, the load, and the registered queries."""

from . import q_core, q_io, q_load, q_marts, q_nested  # noqa: F401  (registers queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
