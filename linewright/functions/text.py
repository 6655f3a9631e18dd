"""Text helpers with the whitespace and quoting rules of the log format.

The helpers of this package take and return Spark SQL expression text, so one output
column is one ``F.expr`` however long its rule is.
"""

from __future__ import annotations

# The code points that count as blank when a field is stripped.
_BLANK_CODES = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
_ESCAPED = "".join(f"\\u{code:04X}" for code in _BLANK_CODES)
BLANKS = f"'{_ESCAPED}'"
BLANK_CLASS = f"[{_ESCAPED}]"
_SPACE = 0x20


def regex(pattern: str) -> str:
    """SQL literal of a regular expression; the pattern holds no single quote."""
    return f"r'{pattern}'"


def literal(text: str) -> str:
    """SQL literal of any text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def has_odd_blank(x: str) -> str:
    """Whether a blank other than the plain space occurs.

    Substring searches only: a regular expression over all blanks costs many times more,
    and nearly every line takes the plain-space way that this test opens. The loop over
    the blanks is a lambda to keep the generated code short enough for the JIT compiler.
    """
    listed = lambda codes: ",".join(f"'\\u{code:04X}'" for code in codes if code != _SPACE)
    ascii_ = listed(c for c in _BLANK_CODES if c < 0x80)
    wide = listed(c for c in _BLANK_CODES if c >= 0x80)
    return (
        f"(exists(array({ascii_}), b -> contains({x}, b)) or (octet_length({x}) <> length({x}) "
        f"and exists(array({wide}), b -> contains({x}, b))))"
    )


def strip(x: str) -> str:
    """Remove blanks at both ends."""
    return f"trim(BOTH {BLANKS} FROM {x})"


def strip_left(x: str) -> str:
    return f"trim(LEADING {BLANKS} FROM {x})"


def strip_right(x: str) -> str:
    return f"trim(TRAILING {BLANKS} FROM {x})"


def unquote(x: str) -> str:
    """Remove every leading and trailing double quote."""
    return f"trim(BOTH '\"' FROM {x})"


def quoted_text(x: str) -> str:
    """Render text as a quoted literal: single quotes unless only they occur inside."""
    escaped = f"replace({x}, '\\\\', '\\\\\\\\')"
    return (
        f"if(contains({x}, '\\'') and not contains({x}, '\"'), concat('\"', {escaped}, '\"'), "
        f"concat('\\'', replace({escaped}, '\\'', '\\\\\\''), '\\''))"
    )


def quoted_list(x: str) -> str:
    """Render an array of text as ``['a', 'b']``."""
    return f"concat('[', array_join(transform({x}, q -> {quoted_text('q')}), ', '), ']')"
