"""Comma splitting and list literals for bracketed fields."""

from __future__ import annotations

from linewright.functions.text import BLANK_CLASS, regex, strip


def _depth_after(depth: str, piece: str, opening: str, closing: str) -> str:
    """The depth behind a piece, bracket by bracket; it never falls below zero."""
    found = f"regexp_extract_all({piece}, {regex(f'[{chr(92)}{opening}{chr(92)}{closing}]')}, 0)"
    return (
        f"if(contains({piece}, '{opening}') or contains({piece}, '{closing}'), "
        f"aggregate({found}, {depth}, (d, c) -> if(c = '{opening}', d + 1, greatest(d - 1, 0))), {depth})"
    )


def _closed(depth: int) -> str:
    """Pattern of one bracket with its whole content, brackets up to ``depth`` deep, all closed in turn."""
    inner = r"[^\[\]()]++"
    for _ in range(depth):
        found = rf"\[(?:{inner})*+\]|\((?:{inner})*+\)"
        inner = rf"[^\[\]()]++|{found}"
    return found


# Every loop is possessive, so matching is linear and needs no stack.
_CLOSED = _closed(4)
#: Texts whose brackets are closed in turn; a first comma would hide from the search for tokens.
_REGULAR = rf"^(?!,)(?:[^\[\]()]++|{_CLOSED})*+\z"
_TOKEN = rf"(?:^|,)((?:[^,\[\]()]++|{_CLOSED})*+)"


def split_nested(text: str) -> str:
    """Split on commas outside ``[]`` and ``()``; each token is stripped.

    Where brackets are closed in turn, a regular expression cuts the text. Elsewhere a fold runs
    over plain comma pieces and carries the depth of either bracket, so a depth never falls below
    zero and a stray closing bracket has no effect.
    """
    cut = f"if(t rlike {regex(_REGULAR)}, regexp_extract_all(t, {regex(_TOKEN)}, 1), {_folded('t')})"
    stripped = f"transform({cut}, x -> {strip('x')})"
    # Stripping every token is slow, and few texts hold a blank.
    return f"get(transform(array({text}), t -> if(t rlike {regex(BLANK_CLASS)}, {stripped}, {cut})), 0)"


def _folded(text: str) -> str:
    """The tokens of ``split_nested`` before they are stripped."""
    outside = "a.square = 0 and a.paren = 0 and a.piece is not null"
    start = (
        "named_struct('square', 0, 'paren', 0, 'piece', cast(null as string), "
        "'done', cast(array() as array<string>))"
    )
    step = (
        f"named_struct('square', {_depth_after('a.square', 'x', '[', ']')}, "
        f"'paren', {_depth_after('a.paren', 'x', '(', ')')}, "
        f"'piece', if({outside} or a.piece is null, x, concat(a.piece, ',', x)), "
        f"'done', if({outside}, array_append(a.done, a.piece), a.done))"
    )
    return f"aggregate(split({text}, ','), {start}, (a, x) -> {step}, a -> array_append(a.done, a.piece))"


#: Tokens of a literal: quoted text with its prefix, a bracket or comma, anything between, a stray quote.
_TOKENS = (
    r"(?s)[uUrR]?\x22(?:[^\x22\\]|\\.)*\x22|[uUrR]?\x27(?:[^\x27\\]|\\.)*\x27|[\[\](),]"
    r"|[^\[\](),\x22\x27]+?(?=[uUrR]?[\x22\x27]|[\[\](),]|$)|[\x22\x27]"
)
_DECIMAL = r"^[+-]?(?:[0-9]+[.][0-9]*|[.][0-9]+|[0-9]+(?=[eE]))(?:[eE][+-]?[0-9]+)?$"
#: Pieces of quoted text: an escape, or what stands between escapes.
_PIECES = r"(?s)\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|.)|[^\\]+"
#: Digits of numbers with a base (fixed values): prefix, digits, base, most digits of 64 bits.
_BASES = (("x", "0-9a-fA-F", 16, 16), ("o", "0-7", 8, 21), ("b", "01", 2, 64))
#: Escapes of one letter (fixed values); behind any other letter the backslash stays.
_LETTERS = {"n": 10, "t": 9, "r": 13, "b": 8, "f": 12, "a": 7, "v": 11}


def _written_out(depth: int) -> str:
    """Pattern of a tidy literal of whole numbers, lists and tuples, brackets up to ``depth`` deep.

    The next character always decides and every loop is possessive, so matching is linear.
    """
    value = number = "(?:0|-?[1-9][0-9]*+)"
    for _ in range(depth):
        value = rf"(?:{number}|\[(?:{value}(?:,{value})*+)?+\]|\((?:{value}(?:,{value})++)?+\))"
    return rf"^{value}\z"


#: What most fields of real lines hold, gear included; it is its own tidy spelling.
_TIDY = _written_out(3)
#: A whole number that is grouped by parens.
_GROUPED = r"(?<![^\[(,])\((0|-?[1-9][0-9]*+)\)(?![^\]),])"


def _code_point(hex_digits: str) -> str:
    return f"decode(unhex(lpad({hex_digits}, 8, '0')), 'UTF-32')"


def _unescaped(p: str) -> str:
    """The text of one piece; null for an escape that is cut short or a named one."""
    letters = " ".join(f"when {p} = concat('\\\\', '{letter}') then char({code})" for letter, code in _LETTERS.items())
    return (
        f"(case when left({p}, 1) <> '\\\\' then {p} when {p} = '\\\\\n' then '' "
        f"when {p} in ('\\\\\\\\', '\\\\\\'', '\\\\\"') then substring({p}, 2) {letters} "
        f"when {p} rlike r'^.[xuU].' then {_code_point(f'substring({p}, 3)')} "
        f"when {p} rlike r'^.[0-7]' then {_code_point(f'conv(substring({p}, 2), 8, 16)')} "
        f"when {p} rlike r'^.[xuUN]$' then null else {p} end)"
    )


def _quoted(t: str) -> str:
    """JSON text of quoted text; what is a bracket or comma elsewhere is escaped in it."""
    prefix = f"if({t} rlike r'^[uUrR]', 1, 0)"
    inner = f"substring({t}, 2 + {prefix}, length({t}) - 2 - {prefix})"
    pieces = f"transform(regexp_extract_all({inner}, {regex(_PIECES)}, 0), p -> {_unescaped('p')})"
    # Joining skips nulls, so a bad escape is looked for apart.
    decoded = f"transform(array({pieces}), s -> if(exists(s, q -> q is null), null, array_join(s, '')))[0]"
    text = f"if({t} rlike r'^[rR]', {inner}, if(contains({inner}, '\\\\'), {decoded}, {inner}))"
    json = f"transform(array({text}), s -> regexp_extract(to_json(named_struct('s', s)), '(?s)^.....(.*).$', 1))[0]"
    for c in "[](),":
        json = f"replace({json}, '{c}', r'\\u{ord(c):04x}')"
    return json


def _scalar(t: str) -> str:
    """JSON text of a number, None, a truth value or quoted text; null when it is none."""
    # A sign may stand apart; an underscore stands between two digits.
    tight = f"replace(regexp_replace({t}, r'^([+-])[ \\t\\f]+', '$1'), '_', '')"
    loose = f"{t} rlike r'(?<![0-9])_|_(?![0-9])'"
    number = f"regexp_replace(regexp_replace(n, r'^[+]', ''), r'^(-?)0+(?=[0-9])', '$1')"
    number = f"regexp_replace(regexp_replace({number}, r'^(-?)[.]', '$10.'), r'[.](?![0-9])', '.0')"
    based = ""
    for letter, digits, base, most in _BASES:
        pattern = f"^[+-]?[ \\t\\f]*0[{letter}{letter.upper()}](?:_?[{digits}])+$"
        bare = "regexp_replace(n, r'^[+-]?0.0*(?=.)', '')"
        value = f"conv({bare}, {base}, 10)"
        # Numbers beyond 64 bits are unreadable.
        based += (
            f"when {t} rlike {regex(pattern)} then if(length({bare}) > {most}, null, "
            f"concat(if(startswith(n, '-') and {value} <> '0', '-', ''), {value})) "
        )
    rules = (
        f"case when {t} = 'None' then 'null' when {t} = 'True' then 'true' when {t} = 'False' then 'false' "
        f"{based} when {loose} then null when n rlike r'^[+-]?0+$' then '0' "
        f"when n rlike r'^[+-]?[1-9][0-9]*$' then ltrim('+', n) when n rlike {regex(_DECIMAL)} then {number} end"
    )
    return (
        f"(case when {t} rlike r'^-?[1-9][0-9]*$' then {t} when length({t}) > 1 and {t} rlike r'^[uUrR]?[\\x22\\x27]' then {_quoted(t)} "
        f"else transform(array({tight}), n -> {rules})[0] end)"
    )


def tidy_literal(token: str) -> str:
    """One spelling of a literal: JSON scalars, lists in ``[]``, tuples in ``()``; null if malformed.

    A fold over the tokens with a stack of open brackets, so depth has no limit. Parens
    without a comma of their own only group and are dropped: ``((5))`` is a number, ``(5,)``
    and ``(1,2)`` are tuples. Literals that are tidy as they are skip the fold.
    """
    text = (
        f"if({token} rlike r'[\\x22\\x27]', {token}, "
        f"regexp_replace({token}, r'(?<![0-9eE])[+](?=[0-9(])', ''))"
    )
    start = (
        "named_struct('out', '', 'stack', "
        "cast(array() as array<struct<at: int, open: string, comma: boolean>>), 'ok', true)"
    )
    state = lambda out, stack, ok: f"named_struct('out', {out}, 'stack', {stack}, 'ok', {ok})"
    # A value stands at the start, behind an opening bracket or behind a comma.
    free = "(a.out = '' or right(a.out, 1) in ('[', '(', ','))"
    top, rest = "element_at(a.stack, -1)", "slice(a.stack, 1, size(a.stack) - 1)"
    push = state(
        "concat(a.out, t.token)",
        "array_append(a.stack, named_struct('at', length(a.out), 'open', t.token, 'comma', false))",
        f"a.ok and {free}",
    )
    comma = state(
        "concat(a.out, ',')",
        f"array_append({rest}, named_struct('at', {top}.at, 'open', {top}.open, 'comma', true))",
        f"a.ok and not {free}",
    )
    grouping = f"{top}.open = '(' and not {top}.comma and right(a.out, 1) <> '('"
    pop = state(
        f"if({grouping}, concat(left(a.out, {top}.at), substring(a.out, {top}.at + 2)), "
        "concat(regexp_replace(a.out, ',$', ''), t.token))",
        rest, f"a.ok and {top}.open = if(t.token = ')', '(', '[')",
    )
    value = state("concat(a.out, coalesce(t.value, ''))", "a.stack", f"a.ok and {free} and t.value is not null")
    # Texts side by side are one text.
    joined = state("concat(left(a.out, length(a.out) - 1), substring(t.value, 2))", "a.stack", "a.ok")
    step = (
        f"(a, t) -> case when not a.ok or t.token = '' then a when t.token in ('[', '(') then {push} "
        f"when t.token not in (',', ']', ')') then if(right(a.out, 1) = '\"' and startswith(t.value, '\"'), {joined}, {value}) "
        f"when size(a.stack) = 0 then {state('a.out', 'a.stack', 'false')} "
        f"when t.token = ',' then {comma} else {pop} end"
    )
    stripped = f"transform(regexp_extract_all({text}, {regex(_TOKENS)}, 0), t -> {strip('t')})"
    tokens = f"transform({stripped}, t -> named_struct('token', t, 'value', if(t in ('', '[', ']', '(', ')', ','), null, {_scalar('t')})))"
    folded = f"aggregate({tokens}, {start}, {step}, a -> if(a.ok and size(a.stack) = 0 and a.out <> '', a.out, null))"
    bare = f"regexp_replace({token}, {regex(_GROUPED)}, '$1')"
    return f"get(transform(array({bare}), w -> if(w rlike {regex(_TIDY)}, w, {folded})), 0)"


def literal_json(tidy: str) -> str:
    """JSON text of a tidied literal, null when it is none."""
    text = f"translate({tidy}, '()', '[]')"
    # A lambda, as the text is needed twice and its rule is long.
    return f"get(transform(array({text}), j -> if(try_parse_json(j) is not null, j, null)), 0)"


def json_items(json: str) -> str:
    """Top-level items of a JSON array as text."""
    return f"from_json({json}, 'array<string>')"
