"""Attributes of stored HTML pages."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame

from linewright.functions.scalars import as_float
from linewright.functions.text import literal, regex, strip

# The numeric attributes of a page.
FIELDS = ["strength", "agility", "stamina"]
_TAG = r"<[^>]+>"
_HEADING = r"(?is)<h1(?:\s[^>]*)?>.*?</h1>"


# Names of HTML; those that may lack the semicolon are there without it as well.
_LEGACY = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
_ENTITY = r"&(?:#[0-9]{1,7}(?![0-9]);?|#[xX][0-9a-fA-F]{1,6}(?![0-9a-fA-F]);?|[a-zA-Z][a-zA-Z0-9]*;?)|[^&]+|&"


def decode_entities(text: str) -> str:
    """Named and numbered entities to their characters; unknown ones stay as written.

    The semicolon may be missing where HTML takes that: after a number, and after the longest
    start of a name that is an old one. A fold over the pieces of the text, so what an entity decodes to is not decoded again.
    """
    names = ", ".join(f"'{name}', {literal(c)}" for name, c in html5.items())
    named = f"element_at(map({names}), name)"
    old = f"regexp_extract(e, '^&({_LEGACY})', 1)"
    code = (
        "case when e rlike '^&#[0-9]+;?$' then cast(translate(substring(e, 3), ';', '') as int) "
        "when e rlike '^&#[xX][0-9a-fA-F]+;?$' then cast(conv(translate(substring(e, 4), ';', ''), 16, 10) as int) end"
    )
    # chr covers one byte; wider characters are made of UTF-16 units.
    wide = (
        "decode(unhex(if(c < 65536, lpad(hex(c), 4, '0'), concat(hex(55296 + ((c - 65536) div 1024)), "
        "hex(56320 + ((c - 65536) % 1024))))), 'UTF-16BE')"
    )
    numbered = f"get(transform(array({code}), c -> if(c between 1 and 1114111 and not c between 55296 and 57343, {wide}, null)), 0)"
    # The whole name where it is known, else its old start and the rest as written.
    found = f"transform(array(substring(e, 2), {old}), name -> {named})"
    text_ = f"get(transform(array({found}), f -> coalesce(f[0], concat(f[1], substring(e, length({old}) + 2)))), 0)"
    piece = f"if(startswith(e, '&') and length(e) > 2, coalesce({numbered}, {text_}, e), e)"
    pieces = f"array_join(transform(regexp_extract_all({text}, {regex(_ENTITY)}, 0), e -> {piece}), '')"
    return f"if(contains({text}, '&'), {pieces}, {text})"


def _inner_text(html: str, pattern: str) -> str:
    inner = f"nullif(regexp_extract({html}, {regex(pattern)}, 0), '')"
    return decode_entities(f"regexp_replace({inner}, {regex(_TAG)}, '')")


def extract_page_attributes(
    pages: DataFrame, *, key: str = "page_id", html: str = "html", fields: list[str] | None = None
) -> DataFrame:
    """``key``, the text of the first ``h1`` as ``name``, and a DOUBLE per field.

    A field is the first ``span`` whose class list holds its name; the attribute may be
    unquoted. Entities are decoded. What is missing or no number is null.
    """
    wanted = fields if fields is not None else FIELDS

    def number(field: str) -> str:
        quoted = rf"[\x22\x27](?:[^\x22\x27]*\s)?{field}(?:\s[^\x22\x27]*)?[\x22\x27]"
        pattern = rf"(?is)<span(?=[^>]*\bclass\s*=\s*(?:{quoted}|{field}(?=[\s>])))[^>]*>.*?</span>"
        return f"{as_float(strip(_inner_text(html, pattern)))} as {field}"

    return pages.selectExpr(
        key,
        f"{_inner_text(html, _HEADING)} as name",
        *[number(f) for f in wanted],
    )


def append_attributes(attributes: DataFrame, path: str) -> None:
    """Append the rows as NDJSON."""
    attributes.write.mode("append").json(path)
