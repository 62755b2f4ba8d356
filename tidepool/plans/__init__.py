"""Named analytics over the driver tables and their SQL oracles."""

from tidepool.plans.registry import QUERIES, ORACLE, register

__all__ = ["QUERIES", "ORACLE", "register"]
