"""All named queries: importing this module fills the catalogue."""

from pricecast.plans import (  # noqa: F401
    evaluation_queries,
    governance_queries,
    model_queries,
    panel_queries,
    profile_queries,
    scoring_queries,
)
from pricecast.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
