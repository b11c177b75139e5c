"""Numeric column functions: guarded ratios, engagement rate, cost estimate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference behaviour) -------------------
COST_PER_RESULT_USD = 0.0023
# ---------------------------------------------------------------------------


def guarded_ratio(num: Column, den: Column) -> Column:
    """num/den as 32-bit FLOAT, NULL unless den > 0."""
    return F.when(den > 0, (num.cast("float") / den).cast("float"))


def engagement_rate(engagement: Column, followers: Column) -> Column:
    return F.when(followers > 0, engagement.cast("double") / followers)


def scrape_cost(n_targets: Column, results_limit: Column) -> Column:
    return n_targets * results_limit * F.lit(COST_PER_RESULT_USD)
