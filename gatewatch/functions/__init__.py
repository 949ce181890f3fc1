from gatewatch.functions.columns import (
    event_time_from,
    has_location,
    is_kind,
    iso_text,
    or_unknown,
    seconds_between,
    success_count,
)

__all__ = [
    "event_time_from", "has_location", "is_kind", "iso_text",
    "or_unknown", "seconds_between", "success_count",
]
