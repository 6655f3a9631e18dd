"""Date and time text to an instant, with the year rules of the log format."""

from __future__ import annotations

from datetime import datetime

from linewright.functions.text import literal, regex

# Fixed value: the year of a date without one when the file name gives none.
DEFAULT_YEAR = 2023
# Fixed value: a yearless date more than this many whole days ahead is last year's.
MAX_DAYS_AHEAD = 180

DATE = r"^[+-]?[0-9]+(?:/[+-]?[0-9]+)+$"
TIME = r"^(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:[0-5]?[0-9]\.[0-9]{1,6}$"
OFFSET = r"[+-][0-9]{1,2}(?::?[0-9]{2})?$"
_DAY_US = 86_400_000_000


def time_without_offset(t: str) -> str:
    cut = f"regexp_replace({t}, {regex(OFFSET)}, '')"
    return f"if(contains({t}, '-') or contains({t}, '+'), {cut}, {t})"


def time_offset(t: str) -> str:
    """The dropped offset text, null when there is none."""
    return f"nullif(regexp_extract({t}, {regex(OFFSET)}, 0), '')"


def now_micros(now: datetime | None, log_tz: str) -> str:
    """Wall-clock reading of ``now`` in the log zone, as if it were UTC micros."""
    if now is None:
        return f"unix_micros(from_utc_timestamp(current_timestamp(), {literal(log_tz)}))"
    delta = now.replace(tzinfo=None) - datetime(1970, 1, 1)
    return f"{(delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds}L"


# Columns that ``instant`` reads; compute them in a projection of their own.
CLOCK_PARTS = {
    "month": "try_cast(get(date_split, 0) as int)",
    "day": "try_cast(get(date_split, 1) as int)",
    "written_year": "try_cast(get(date_split, 2) as int)",
    "hour": "try_cast(get(time_split, 0) as int)",
    "minute": "try_cast(get(time_split, 1) as int)",
    "second": "try_cast(get(time_split, 2) as decimal(16,6))",
}


def valid_date(date: str) -> str:
    return f"{date} rlike {regex(DATE)}"


def valid_time(time: str) -> str:
    return f"{time} rlike {regex(TIME)}"


def instant(
    *,
    log_tz: str = "UTC",
    now: datetime | None = None,
    default_year: int = DEFAULT_YEAR,
) -> str:
    """TIMESTAMP in ``log_tz`` from ``CLOCK_PARTS`` and ``year_hint``; null when no such day.

    A written year wins, then the hint. Two digits below 70 are 20xx, others 19xx.
    """

    def at(year: str, zone: str) -> str:
        return f"try_make_timestamp({year}, month, day, hour, minute, second, {literal(zone)})"

    written = """case when written_year < 70 then written_year + 2000
                      when written_year < 100 then written_year + 1900
                      else written_year end"""
    ahead = f"unix_micros({at(str(default_year), 'UTC')}) - {now_micros(now, log_tz)}"
    # A lambda, as few lines need it: generated code stays short enough for the JIT compiler.
    guessed = (
        f"get(transform(array({default_year}), y -> "
        f"if({ahead} >= {(MAX_DAYS_AHEAD + 1) * _DAY_US}L, y - 1, y)), 0)"
    )
    year = f"""case when written_year is not null
                      then case when {written} between 1000 and 9999 then {written} end
                    when year_hint is not null then year_hint
                    else {guessed} end"""
    return at(year, log_tz)


def epoch_seconds(instant: str) -> str:
    """Whole seconds plus the fraction, as DOUBLE."""
    return (
        f"(cast(unix_seconds({instant}) as double) + pmod(unix_micros({instant}), 1000000L) / 1e6D)"
    )
