"""Calendar expressions on zone-less timestamps.

Everything here works on TIMESTAMP_NTZ or DATE through field extraction, so no result
depends on the session time zone or on the JVM locale, and every expression stays inside
whole-stage codegen (no formatter objects per row).
"""

from __future__ import annotations

# English names as the reports print them, Sunday and January first.
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)


def minutes_between(start: str, end: str) -> str:
    """Number of minute boundaries crossed from ``start`` to ``end`` (BIGINT).

    10:00:59 -> 10:01:01 is 1 and 10:00:01 -> 10:00:59 is 0: both sides drop their seconds
    first, the elapsed time is never truncated.  Elapsed seconds less the difference of the
    two second fields is a whole number of minutes, up to the dropped fractions of a second
    that rounding removes.  BIGINT, because a broken clock (year 9999) would overflow an INT
    before the row can be filtered.
    """
    elapsed = f"CAST(CAST({end} - {start} AS INTERVAL SECOND) AS BIGINT)"
    return f"CAST(rint(({elapsed} - second({end}) + second({start})) / 60) AS BIGINT)"


def weekday_number(day: str) -> str:
    """Sunday = 1 ... Saturday = 7."""
    return f"dayofweek({day})"


def _pick(names: tuple[str, ...], position: str) -> str:
    listed = ", ".join(f"'{name}'" for name in names)
    return f"element_at(array({listed}), {position})"


def weekday_name(day: str) -> str:
    return _pick(WEEKDAY_NAMES, weekday_number(day))


def month_name(day: str) -> str:
    return _pick(MONTH_NAMES, f"month({day})")


def two_digits(number: str) -> str:
    return f"lpad(CAST({number} AS STRING), 2, '0')"


def year_month(day: str) -> str:
    """``2021-03``"""
    return f"concat(CAST(year({day}) AS STRING), '-', {two_digits(f'month({day})')})"


def date_key(year: str, month: str, day: str) -> str:
    """yyyyMMdd as INT from its three parts."""
    return f"CAST({year} * 10000 + {month} * 100 + {day} AS INT)"


def date_key_of(day: str) -> str:
    """yyyyMMdd as INT from a date or timestamp."""
    return date_key(f"year({day})", f"month({day})", f"day({day})")
