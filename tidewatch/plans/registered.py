"""Importing this module registers every query."""

from tidewatch.plans import accounts, evaluation, storage, streams, telemetry, text, traces, vectors  # noqa: F401
from tidewatch.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
