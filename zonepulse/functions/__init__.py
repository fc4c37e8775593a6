from zonepulse.functions.calendar import (
    WEEKDAYS,
    epoch_micros,
    epoch_seconds,
    instant_from_ntz,
    label_weekdays,
    ntz_from_instant,
    time_parts,
    weekday_position,
)
from zonepulse.functions.measures import (
    duration_hours,
    duration_minutes,
    finite_or_null,
    speed_mph,
)
from zonepulse.functions.quantiles import percentile_approx, percentile_disc, threshold_frame, threshold_value

__all__ = [
    "WEEKDAYS",
    "label_weekdays",
    "weekday_position",
    "epoch_micros",
    "epoch_seconds",
    "instant_from_ntz",
    "ntz_from_instant",
    "time_parts",
    "duration_hours",
    "duration_minutes",
    "finite_or_null",
    "speed_mph",
    "percentile_approx",
    "percentile_disc",
    "threshold_frame",
    "threshold_value",
]
