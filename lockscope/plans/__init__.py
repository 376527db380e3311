"""Registered queries: every operator run over the given tables, with its SQL twin."""

from . import dedup, expressions, incremental, joins, outcomes, parsing, reporting  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
