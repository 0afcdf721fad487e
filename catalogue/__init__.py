"""Queries over the given tables, each with the SQL that must return the same rows."""

from catalogue import configs, features, lab, pipeline, shaping, signals, sources, streams, timing  # noqa: F401
from catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
