"""Import every operator module so that the registry is complete."""

from horavento.llm import (  # noqa: F401
    collocations, decontaminate, html_text, knn, language_model, licences, line_dedup, near_dedup, packing, periodic_runs, pii,
    quality, quality_rules,
)
from horavento.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
