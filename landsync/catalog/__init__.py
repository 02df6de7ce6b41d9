"""Queries of every operator on the driver's tables, each with its SQL."""

from landsync.catalog.registry import ORACLES, QUERIES  # noqa: F401
from landsync.catalog import facility, plan, runs, text, web  # noqa: F401  (these register their queries)
