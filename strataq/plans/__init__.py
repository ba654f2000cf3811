"""Registered queries of the question-curation engine and the SQL they equal."""

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
