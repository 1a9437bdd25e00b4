"""Registered queries over the driver tables, each beside its SQL where SQL can say it."""

from revtide.plans import (  # noqa: F401
    delivery_queries,
    geo_queries,
    history_queries,
    inventory_queries,
    maintenance_queries,
    retrieval_queries,
    telemetry_queries,
)
from revtide.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
