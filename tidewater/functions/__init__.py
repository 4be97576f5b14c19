"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from tidewater.functions.text import (
    base_name, html_escape, is_true, mqtt_filter, ends_with_any_case, new_id, title_from_file, two_decimals,
)
from tidewater.functions.time import (
    elapsed_days, format_or_raw, from_epoch, parse_iso, period_start, weekday_name,
)

__all__ = [
    "base_name", "html_escape", "is_true", "mqtt_filter", "ends_with_any_case",
    "title_from_file", "new_id", "two_decimals", "from_epoch", "elapsed_days", "format_or_raw", "parse_iso",
    "period_start", "weekday_name",
]
