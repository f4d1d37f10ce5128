"""All registered queries."""

from ledgersift.plans import (  # noqa: F401  (imported for their registrations)
    aggregate_queries,
    boosting_queries,
    model_queries,
    row_queries,
    stream_queries,
    table_queries,
)
from ledgersift.plans.catalog import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
