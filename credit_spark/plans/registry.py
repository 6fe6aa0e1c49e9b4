"""Imports every query module so that all queries are registered."""

from . import queries_clean, queries_features, queries_models  # noqa: F401
from .catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
