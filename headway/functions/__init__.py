"""Column-to-Column functions; all stay inside the JVM."""

from headway.functions.clock import (
    epoch_seconds, from_epoch, iso_date, iso_timestamp, next_local_midnight,
    service_date, to_instant,
)
from headway.functions.geo import float_text, grid_coordinates, nws_grid_id, valid_lat_lon
from headway.functions.numeric import (
    c_to_f, feet_to_miles, fraction_to_pct, meters_to_miles, py_round,
)
from headway.functions.status import (
    duration_text, error_category, is_error_event, is_widening, staleness,
)
from headway.functions.text import flag, leading_number, strip, text_or_empty, text_or_null

__all__ = [
    "c_to_f", "duration_text", "epoch_seconds", "error_category", "feet_to_miles",
    "flag", "float_text", "fraction_to_pct", "from_epoch", "grid_coordinates",
    "is_error_event", "is_widening", "iso_date", "iso_timestamp", "leading_number",
    "meters_to_miles", "next_local_midnight", "nws_grid_id", "py_round",
    "service_date", "staleness", "strip",
    "text_or_empty", "text_or_null", "to_instant",
    "valid_lat_lon",
]
