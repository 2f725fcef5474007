"""All registered queries."""

from stumpline.plans import (  # noqa: F401
    queries_delivery,
    queries_decision,
    queries_engagement,
    queries_players,
    queries_users,
)
from stumpline.plans.registry import QUERIES

__all__ = ["QUERIES"]
