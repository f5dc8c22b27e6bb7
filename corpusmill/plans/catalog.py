"""Imports every module that registers queries."""

from corpusmill.plans import q_discovery, q_files, q_shards, q_streams  # noqa: F401
from corpusmill.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
