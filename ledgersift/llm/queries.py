"""All registered text queries."""

from ledgersift.llm import (  # noqa: F401  (imported for their registrations)
    bpe,
    decontaminate,
    hard_negatives,
    language_id,
    license_scan,
    line_dedup,
    minhash_dedup,
    near_dedup,
    periodic_runs,
    quality_rules,
    secret_scan,
    toxicity,
    url_filter,
)
from ledgersift.llm.common import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
