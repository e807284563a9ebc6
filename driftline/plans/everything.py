"""All queries of the core and their SQL."""

from driftline.plans import control, exchange  # noqa: F401  (they register their queries)
from driftline.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
