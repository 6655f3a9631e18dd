"""Typed readings of one log field. Every input is already stripped of blanks.

A regular-expression guard comes before each cast, so a bad value never reaches a
cast that would fail: failing casts are slow and depend on the ANSI setting.
"""

from __future__ import annotations

from linewright.functions.text import regex

DECIMAL = r"^[+-]?(?:0+|[1-9][0-9]*)$"
PLAIN_HEX = r"^0x[0-9a-fA-F]{1,15}$"
PREFIXED = (
    r"^[+-]?0(?:[xX]0*(?:[0-9a-fA-F]{1,15}|[0-7][0-9a-fA-F]{15})|[bB]0*[01]{1,63}|[oO]0*[0-7]{1,21})$"
)
BASE10 = r"^[+-]?[0-9]+$"
FLOAT = (
    r"^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))$"
)


def _plain_hex(x: str) -> str:
    return f"cast(conv(substring({x}, 3), 16, 10) as bigint)"


def as_int(x: str, default: int | None = None) -> str:
    """Integer with a base prefix (``0x``, ``0b``, ``0o``) or plain decimal.

    Leading zeros, fractions, ``nil`` and anything beyond 64 bits give the default.
    """
    base = f"case lower(regexp_extract({x}, '0([a-zA-Z])', 1)) when 'x' then 16 when 'b' then 2 else 8 end"
    digits = f"regexp_extract({x}, '0[a-zA-Z](.+)$', 1)"
    signed = f"if(startswith({x}, '-'), -1L, 1L) * cast(conv({digits}, {base}, 10) as bigint)"
    value = (
        f"case when {x} rlike {regex(DECIMAL)} then try_cast({x} as bigint) "
        f"when {x} = 'nil' then null "
        f"when {x} rlike {regex(PLAIN_HEX)} then {_plain_hex(x)} "
        f"when {x} rlike {regex(PREFIXED)} then {signed} end"
    )
    return f"({value})" if default is None else f"coalesce({value}, {default}L)"


def as_flag_int(x: str) -> str:
    """``as_int`` with default 0 that tries the hexadecimal form of bit sets first."""
    return f"if({x} rlike {regex(PLAIN_HEX)}, {_plain_hex(x)}, {as_int(x, 0)})"


def as_float(x: str, default: float | None = None) -> str:
    value = f"case when {x} rlike {regex(FLOAT)} then try_cast({x} as double) end"
    return f"({value})" if default is None else f"coalesce({value}, {default}D)"


def as_bool(x: str) -> str:
    """True when the field is a non-zero integer, null when it is no integer."""
    return f"({as_int(x)} <> 0)"


def base10_int(x: str) -> str:
    """Decimal integer, leading zeros allowed, no base prefix; null otherwise."""
    return f"(case when {x} rlike {regex(BASE10)} then try_cast({x} as bigint) end)"
