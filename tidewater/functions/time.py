"""Date and time helpers. Everything is UTC inside the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, Sunday first (index 1 = Sunday, matching
# Spark's dayofweek numbering).
WEEKDAYS_EN = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
WEEKDAYS_TR = ["Pazar", "Pazartesi", "Salı", "Çarşamba", "Perşembe", "Cuma", "Cumartesi"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_ts(value, like: str = "timestamp") -> Column:
    """Literal or column -> timestamp column (strings parsed as UTC).

    ``like="timestamp_ntz"`` builds a zone-less literal, so a comparison
    with a ``timestamp_ntz`` column needs no cast of the column and stays
    pushable into the Parquet scan."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast(like)


def ts_type(df, col: str) -> str:
    """'timestamp_ntz' or 'timestamp' - the type of ``col`` for literals."""
    from pyspark.sql.types import TimestampNTZType
    return "timestamp_ntz" if isinstance(df.schema[col].dataType, TimestampNTZType) else "timestamp"


def parse_iso(col) -> Column:
    """ISO-8601 text (``Z`` or offset accepted) -> timestamp, NULL if bad."""
    return _c(col).try_cast("timestamp")


def elapsed_days(start, end) -> Column:
    """Whole elapsed 24-hour days between two instants (not calendar days)."""
    return F.timestamp_diff("DAY", _c(start), _c(end))


def period_start(ts, period_s: int) -> Column:
    """Start of the tumbling period (aligned to the epoch) containing ``ts``."""
    return F.window(_c(ts), f"{int(period_s)} seconds").start


def format_or_raw(col, pattern: str = "MMM dd, yyyy HH:mm") -> Column:
    """Format an ISO text as ``pattern``; keep the original text if unparsable."""
    return F.coalesce(F.date_format(parse_iso(col), pattern), _c(col))


def weekday_name(ts, lang: str = "en") -> Column:
    names = WEEKDAYS_TR if lang == "tr" else WEEKDAYS_EN
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.dayofweek(_c(ts)))


def from_epoch(col) -> Column:
    """Epoch seconds (fractions too) as a timestamp."""
    return F.timestamp_seconds(F.col(col) if isinstance(col, str) else col)
