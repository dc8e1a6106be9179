"""Column expressions: everything here stays inside Catalyst, no Python workers."""

from .geo import haversine_miles
from .holidays import is_us_holiday
from .scalars import (
    complete_units,
    epoch_to_timestamp,
    local_time,
    minutes_between,
    percent_delta,
    ratio,
    safe_divide,
)
from .weekhours import (
    cosine_similarity,
    shift_hours,
    start_slot,
    week_vector,
)

__all__ = [
    "complete_units",
    "cosine_similarity",
    "epoch_to_timestamp",
    "haversine_miles",
    "is_us_holiday",
    "local_time",
    "minutes_between",
    "percent_delta",
    "ratio",
    "safe_divide",
    "shift_hours",
    "start_slot",
    "week_vector",
]
