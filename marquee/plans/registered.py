"""All registered queries: importing a query module registers what it defines."""

from marquee.plans import queries_star, queries_cleaning, queries_profile, queries_similarity, queries_io  # noqa: F401
from marquee.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
