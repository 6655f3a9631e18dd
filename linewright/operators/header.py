"""Line header: time, event name and the comma fields."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewright.functions import clock
from linewright.functions.text import BLANK_CLASS, has_odd_blank, regex, strip

_OTHER = BLANK_CLASS.replace("[", "[^")
_HEADER = f"(?s)^{BLANK_CLASS}*({_OTHER}+){BLANK_CLASS}+({_OTHER}+){BLANK_CLASS}+(.*)$"
_COMMA = f"{BLANK_CLASS}*,{BLANK_CLASS}*"
_UNQUOTED_COMMA = _COMMA + '(?=(?:[^"]*"[^"]*")*[^"]*$)'
MIN_HINT_YEAR = 1970


def year_hint(file: str) -> str:
    """Year in the first four digits of the file name, from 1970 on, else null."""
    digits = f"left(substring_index({file}, '/', -1), 4)"
    year = f"case when {digits} rlike '^[0-9]{{4}}$' then cast({digits} as int) end"
    return f"nullif(greatest({year}, {MIN_HINT_YEAR - 1}), {MIN_HINT_YEAR - 1})"


def parse_header(
    lines: DataFrame,
    *,
    log_tz: str = "UTC",
    now: datetime | None = None,
    default_year: int = clock.DEFAULT_YEAR,
    quote_aware: bool = False,
) -> DataFrame:
    """``lines`` (file, line_no, raw) plus event_time, timestamp, tz_offset, event, cols.

    ``event_time`` is null on a malformed header and ``header_error`` then says why. A
    column ``year_hint`` in the input wins over the year in the file name.
    """
    given = list(lines.columns)
    if "year_hint" not in given:
        lines = lines.selectExpr("*", f"{year_hint('file')} as year_hint")
        given.append("year_hint")
    odd = lambda i, fast: f"if(odd, regexp_extract(raw, {regex(_HEADER)}, {i}), {fast})"
    first = "substring_index(rest, ',', 1)"
    if quote_aware:
        cols = f"split(rest, {regex(_UNQUOTED_COMMA)})"
        n_fields = "size(cols)"
    else:
        cols = f"""split(case
            when odd then regexp_replace(rest, {regex(_COMMA)}, ',')
            when contains(rest, ', ') or contains(rest, ' ,') then regexp_replace(rest, ' *, *', ',')
            else rest end, ',')"""
        n_fields = "length(rest) - length(replace(rest, ',', '')) + 1"
    # ``inline`` keeps later filters on the event name above the cut of the line: pushed
    # further down, they would repeat the whole rule for every line.
    cut = (
        lines.selectExpr("*", f"{has_odd_blank('raw')} as odd", "ltrim(raw) as trimmed")
        .selectExpr(
            *given,
            "odd",
            odd(1, "substring_index(trimmed, ' ', 1)") + " as date_part",
            "ltrim(substring(trimmed, length(substring_index(trimmed, ' ', 1)) + 1)) as after_date",
        )
        .selectExpr(
            *given,
            "odd",
            "date_part",
            odd(2, "substring_index(after_date, ' ', 1)") + " as time_raw",
            odd(3, "trim(substring(after_date, length(substring_index(after_date, ' ', 1)) + 1))")
            + " as untrimmed",
        )
        .selectExpr(
            *given,
            f"""inline(array(named_struct('odd', odd, 'date_part', date_part, 'time_raw', time_raw,
                'rest', nullif(if(odd, {strip('untrimmed')}, untrimmed), ''))))""",
        )
    )
    return (
        cut.selectExpr(
            *given,
            "odd",
            "date_part",
            f"{clock.time_without_offset('time_raw')} as time_part",
            f"{clock.time_offset('time_raw')} as tz_offset",
            "rest",
        )
        .selectExpr(
            "*",
            f"case when rest is not null and {clock.valid_date('date_part')} "
            f"then split(date_part, '/') end as date_split",
            f"case when {clock.valid_time('time_part')} then split(time_part, ':') end as time_split",
        )
        .selectExpr(
            "*",
            *[f"{rule} as {name}" for name, rule in clock.CLOCK_PARTS.items()],
            f"{cols} as cols",
        )
        .selectExpr(
            "*",
            clock.instant(log_tz=log_tz, now=now, default_year=default_year) + " as event_time",
            f"if(odd, {strip(first)}, trim({first})) as first_field",
        )
        .selectExpr(
            *given,
            "event_time",
            f"{clock.epoch_seconds('event_time')} as timestamp",
            "tz_offset",
            "nullif(first_field, '') as event",
            "cols",
            f"{n_fields} as n_fields",
            "rest",
            """case
                 when rest is null then concat('Malformed timestamp: ', substring(raw, 1, 50))
                 when event_time is null
                   then concat('Could not parse timestamp: ', date_part, ' ', time_part)
                 when first_field = '' then 'Empty CSV or missing event after timestamp'
               end as header_error""",
        )
    )
