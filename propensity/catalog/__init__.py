"""Registered queries and, where SQL can express them, the same question as plain SQL."""

from propensity.catalog import (  # noqa: F401
    alignment,
    bins,
    checks,
    encoding,
    evaluation,
    features,
    lines,
    models,
    profiling,
    rates,
    sampling,
)
from propensity.catalog.registry import ORACLES, QUERIES  # noqa: F401
