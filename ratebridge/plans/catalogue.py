"""All registered queries (importing a module registers its queries)."""

from __future__ import annotations

from ratebridge.plans import (  # noqa: F401
    contract_queries,
    generic_queries,
    ingest_queries,
    model_queries,
    payload_queries,
    quality_queries,
    stream_queries,
)
from ratebridge.plans.registry import oracle_sql, queries  # noqa: F401
