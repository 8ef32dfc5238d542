"""All registered queries; importing a module registers its entries."""

from tidewell.plans import (  # noqa: F401
    q_core,
    q_features,
    q_filters,
    q_ingest,
    q_models,
    q_pages,
    q_pairs,
    q_scalars,
    q_scoring,
    q_sessions,
    q_streaming,
    q_text,
)
from tidewell.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
