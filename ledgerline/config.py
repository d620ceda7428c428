"""Run parameters. Every constant the original pipeline hard-coded is a field here."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the original pipeline's for identical results:
# the accepted category list of the staging test, the quality-gate rate, the
# winsorizing percentile, the forecast horizon, hold-out fraction, moving
# average window, seasonal period, minimum history and null-rate warning level.
DEFAULT_ACCEPTED_CATEGORIES = (
    "Electronics", "Furniture", "Office Supplies", "Apparel", "Home & Kitchen", "Unknown",
)


@dataclass(frozen=True)
class PipelineConfig:
    gate_threshold: float = 0.5
    cap_percentile: float = 0.99
    horizon: int = 6
    test_fraction: float = 0.2
    ma_window: int = 3
    season_length: int = 12
    min_history: int = 6
    null_rate_warn: float = 0.05
    accepted_categories: tuple[str, ...] = field(default=DEFAULT_ACCEPTED_CATEGORIES)
    # percentile_approx accuracy, used only to place the bins that narrow a huge
    # group down to the values around an exact quantile
    quantile_accuracy: int = 100000
    # exact quantile plans: "simple" (percentile aggregate) or "bracketed" (counted bins)
    median_method: str = "bracketed"
    cap_method: str = "bracketed"
    # how the exponential smoothing is started: "first_seasons", or "estimated" jointly with its weights
    smoothing_start: str = "first_seasons"
    # confidence band multiplier (about an 80 % interval)
    band_z: float = 1.28
