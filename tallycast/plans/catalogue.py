"""Imports every module that registers queries."""

from tallycast.plans import (  # noqa: F401
    baseline_queries,
    board_queries,
    catalog_queries,
    driver_queries,
    scoring_queries,
    submission_queries,
    streaming_queries,
    target_queries,
)
from tallycast.plans.registry import ORACLES, QUERIES  # noqa: F401
