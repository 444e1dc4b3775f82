"""Column expressions: time, typing, alerts."""

from .alerts import alert_array
from .clock import (
    epoch_micros,
    epoch_seconds,
    instant,
    moment,
    since,
    utc_date,
    with_event_time,
    within,
)
from .typing import reject_reason, typed

__all__ = [
    "alert_array",
    "epoch_micros",
    "epoch_seconds",
    "instant",
    "moment",
    "reject_reason",
    "since",
    "typed",
    "utc_date",
    "with_event_time",
    "within",
]
