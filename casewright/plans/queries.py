"""All registered queries, grouped by subject."""

from casewright.plans import cohort_queries, genotype_queries, incident_queries, io_queries, model_queries, study_queries  # noqa: F401
from casewright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
