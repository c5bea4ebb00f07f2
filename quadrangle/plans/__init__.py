"""Plans over whole tables, and the registered queries with their equivalents in SQL."""

from quadrangle.plans import queries_features, queries_models, queries_tables  # noqa: F401  they register themselves
from quadrangle.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
