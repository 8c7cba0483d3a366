"""Safe casts, time differences, NULL-strict greatest/least, money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# A timestamp text must start with a calendar date to be cast;
# the ISO parser takes "YYYY-MM-DDTHH:MM:SS", optional fraction, then "Z".
DATE_PREFIX = r"^\d{4}-\d{1,2}-\d{1,2}"
ISO_Z = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"


def safe_bigint(s: Column) -> Column:
    """NULL instead of an error; ``'12.5'`` is NULL, not 12."""
    return s.try_cast("bigint")


def safe_bool(s: Column) -> Column:
    """Only ``true``/``false`` (any case) are booleans; ``'1'``/``'yes'`` are NULL."""
    low = F.lower(s)
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def safe_timestamp(s: Column) -> Column:
    """Timestamp from ISO text; text that does not start with a date is NULL."""
    return F.when(s.rlike(DATE_PREFIX), s.try_cast("timestamp"))


def parse_iso_ts(s: Column) -> Column:
    """Strict ``YYYY-MM-DDTHH:MM:SS[.f*]Z`` parse; anything else is NULL."""
    return F.when(s.rlike(ISO_Z), s.try_cast("timestamp"))


def hours_between(end: Column, start: Column) -> Column:
    """Whole elapsed hours, truncated toward zero; NULL if either is NULL."""
    return F.timestamp_diff("HOUR", start, end)


def days_between(end: Column, start: Column) -> Column:
    """Calendar-day difference of two dates, as bigint."""
    return F.datediff(end, start).cast("bigint")


def strict_greatest(*cols: Column) -> Column:
    """``greatest`` that is NULL when any argument is NULL."""
    all_present = cols[0].isNotNull()
    for c in cols[1:]:
        all_present = all_present & c.isNotNull()
    return F.when(all_present, F.greatest(*cols))


def strict_least(*cols: Column) -> Column:
    """``least`` that is NULL when any argument is NULL."""
    all_present = cols[0].isNotNull()
    for c in cols[1:]:
        all_present = all_present & c.isNotNull()
    return F.when(all_present, F.least(*cols))


def discounted_amount(price: Column, discount: Column) -> Column:
    """``-1 * price * discount`` as NUMERIC, i.e. ``decimal(38,9)``."""
    p = price.cast(DecimalType(15, 2))
    d = discount.cast(DecimalType(15, 2))
    return (F.lit(-1) * p * d).cast(DecimalType(38, 9))


def to_ntz(c: Column) -> Column:
    """Wall-clock (UTC session) timestamp without zone, for exchange."""
    return c.cast("timestamp_ntz")
