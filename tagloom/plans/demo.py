"""All registered queries over the synthetic tables."""

from tagloom.plans import demo_basic, demo_products, demo_scalars  # noqa: F401
from tagloom.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
