"""All registered queries; importing the modules fills the registry."""

from __future__ import annotations

from tablewright.plans import (  # noqa: F401
    feature_queries,
    genotype_queries,
    learned_queries,
    metric_queries,
    model_queries,
    relational_queries,
    sampling_queries,
    source_queries,
    workflows,
)
from tablewright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
