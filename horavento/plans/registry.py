"""Import every query module so the registry is complete."""

from horavento.plans import (  # noqa: F401
    analysis_queries, extra_queries, file_queries, ml_queries, model_queries, ordered_queries,
    small_queries, text_queries,
)
from horavento.plans.common import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
