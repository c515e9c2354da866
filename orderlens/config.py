"""Parameters of a run. Everything that changes a result is stated here."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Constants that define the published semantics.
LONG_WINDOW_DAYS = 365
MID_WINDOW_DAYS = 90
SHORT_WINDOW_DAYS = 30
MAX_RECENCY_DAYS = 365
RECENT_GAPS = 8
DEFAULT_GAP_DAYS = 90.0
DEFAULT_GAP_SPREAD = 0.0
MIN_CADENCE_DAYS = 7.0
ABSENT_CATEGORY_RECENCY = 400
POPULARITY_WEIGHT = 0.35
LAST_CATEGORY_WEIGHT = 0.65
PRIORITY_SHARE = 0.15
REVIEW_SHARE = 0.40
TOP_SHARE = 0.20
EARLY_STOPPING_SHARE = 0.1
TIERS = ("Priority", "Review", "Monitor")


@dataclass(frozen=True)
class RunConfig:
    """Snapshot grid, split dates, horizons, class list and model settings."""

    # Of the data at hand; steps that need one of them fail without it.
    snapshot_start: str = ""
    snapshot_end: str = ""
    validation_start: str = ""
    test_start: str = ""
    scoring_date: str = ""
    categories: tuple[str, ...] = ()
    seed: int = 7
    # Grid step, eligibility, horizons and model settings of the published run.
    snapshot_frequency_days: int = 28
    min_history_orders: int = 3
    target_horizon_days: int = 60
    readiness_horizon_days: int = 30
    purge_days: int = 0
    logistic_iterations: int = 700
    logistic_c: float = 0.8
    boosting_rounds: int = 180
    boosting_rate: float = 0.07
    boosting_depth: int = 5
    boosting_min_leaf: int = 30
    boosting_patience: int = 10
    early_stopping_tolerance: float = 1e-7

    def last_grid_index(self) -> int:
        """Index of the last score date that is not after ``snapshot_end``."""
        span = date.fromisoformat(self.snapshot_end) - date.fromisoformat(self.snapshot_start)
        return span.days // self.snapshot_frequency_days
