"""Import every query module so the registry is complete."""

from tidepool.plans import registry
from tidepool.plans import basics, delivery, joins, patterns, streams, userfns, windows  # noqa: F401

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
