"""Time functions (E1–E6). All are JVM-side column expressions.

Instants are ``timestamp`` (session time zone UTC). Wall-clock inputs of type
``timestamp_ntz`` are read as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nanosecond timestamps cover about +-292 years around 1970; by default an epoch
# value outside that range coerces to null.
MAX_EPOCH_SECONDS = 9.2e9


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_instant(c) -> Column:
    """timestamp / timestamp_ntz / date -> timestamp (UTC session)."""
    return _col(c).cast("timestamp")


# an offset only counts after a time of day ("2013-03-01" ends in "-01" but has none)
_HAS_OFFSET = r"[0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?\s*(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"

# Non-ISO layouts tried after the ISO-8601 parse (US month-first and spelled
# months); anything else stays null.
FALLBACK_FORMATS = ["M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "MMMM d, yyyy H:mm", "MMMM d, yyyy",
                    "MMM d, yyyy"]


def lenient_timestamp(c, source_tz: str | None = None) -> Column:
    """Parse mixed ISO-like text with or without offset; junk -> null.

    Offsets (``-04:00``, ``Z``) are honoured, so mixed-offset snapshots land on
    one UTC instant each. Text without an offset is read as UTC, or as wall
    clock in ``source_tz`` when given (e.g. ``America/New_York``). ISO-8601
    first, then ``FALLBACK_FORMATS``.
    """
    text = _col(c).cast("string")
    trimmed = F.trim(text)
    parsed = F.coalesce(F.try_to_timestamp(text),
                        *[F.try_to_timestamp(trimmed, F.lit(fmt)) for fmt in FALLBACK_FORMATS])
    if not source_tz:
        return parsed
    return F.when(F.trim(text).rlike(_HAS_OFFSET), parsed).otherwise(F.to_utc_timestamp(parsed, source_tz))


def strict_timestamp(c, what: str = "timestamp") -> Column:
    """Like E1 but a non-null value that does not parse fails the job."""
    text = _col(c).cast("string")
    parsed = F.try_to_timestamp(text)
    return F.when(text.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"unparseable {what}: "), text))
                  ).otherwise(parsed)


def epoch_seconds_timestamp(c, max_seconds: float = MAX_EPOCH_SECONDS) -> Column:
    """E3 + E16: epoch seconds given as text or number -> timestamp.

    Junk, NaN, infinities and values of ``max_seconds`` or more before or after
    1970 become null; fractional seconds are kept.
    """
    seconds = _col(c).cast("string").try_cast("double")
    # NaN sorts above every number in Spark, so one comparison rejects it too
    return F.when(F.abs(seconds) < F.lit(float(max_seconds)), F.timestamp_seconds(seconds))


def plus_seconds(c, seconds: int) -> Column:
    """Add a fixed duration."""
    return as_instant(c) + F.make_dt_interval(secs=F.lit(seconds))


def utc_date(c) -> Column:
    """E5: UTC calendar date of an instant."""
    return F.to_date(as_instant(c))


def epoch_micros(c) -> Column:
    return F.unix_micros(as_instant(c))


def round_to(c, seconds: int) -> Column:
    """Round an instant to the nearest multiple of ``seconds``.

    Ties go to the even multiple (00:07:30 -> 00:00, 00:22:30 -> 00:30 for 15
    minutes). Exact integer arithmetic on epoch microseconds; works before 1970.
    """
    unit = F.lit(int(seconds) * 1_000_000)
    half = F.lit(int(seconds) * 500_000)
    m = epoch_micros(c)
    rem = F.pmod(m, unit)
    q = F.call_function("div", m - rem, unit)
    up = (rem > half) | ((rem == half) & (F.pmod(q, F.lit(2)) == 1))
    return F.timestamp_micros((q + F.when(up, 1).otherwise(0)) * unit)
