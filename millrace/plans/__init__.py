"""One module per operator family; importing the package registers every query."""

from millrace.plans import (  # noqa: F401
    aggregation,
    context_jobs,
    expressions,
    feature_jobs,
    joining,
    model_jobs,
    scalar,
    semistructured,
    sets_subqueries,
    sinks,
    sketching,
    sorting_sampling,
    sources,
    streams,
    text_jobs,
    transformer_jobs,
    udf_surface,
    windows,
)
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
