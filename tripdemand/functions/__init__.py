"""Column-level helpers (pure Spark SQL expressions)."""

from tripdemand.functions.columns import (
    boundary_diff,
    day_of_week_sun0,
    exact_mean,
    literal_frame,
    month_start,
    round_half_away,
    round_half_even,
    scaled_sum,
)

__all__ = [
    "boundary_diff",
    "day_of_week_sun0",
    "exact_mean",
    "literal_frame",
    "month_start",
    "round_half_away",
    "round_half_even",
    "scaled_sum",
]
