"""Actors, prefixes and payload families of every event, and the status of its line."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewright.functions import clock, flags
from linewright.functions.scalars import as_bool, as_flag_int, as_float, as_int, base10_int
from linewright.functions.text import literal, quoted_list, quoted_text, unquote
from linewright.operators import specs
from linewright.operators.combatant import with_combatant
from linewright.operators.header import parse_header
from linewright.operators.routes import RouteRegistry, route_events
from linewright.operators.specs import Field

# The field counts that make a line whole, the sample size of a warning.
ACTOR_FIELDS = 9
SUMMON_FIELDS = 12
SAMPLE = 6
SUMMON_REASON = "source/dest (8 cols) + spellId, spellName, spellSchool"
SUMMON_MESSAGE = "Incomplete SPELL_SUMMON line"
MARKER_ERROR = "Insufficient data for WORLD_MARKER"
SPELL_ERROR = "Spell data incomplete"
INDEX_ERROR = "list index out of range"
BAD_INT = "invalid literal for int() with base 10: "

_WHOLE = f"n_fields >= {ACTOR_FIELDS + 3}"
_PAYLOAD = "slice(cols, base + 1, rest_n)"


def _int_masks(fix_power_type: bool) -> dict[str, int]:
    """Per layout, the payload positions to read as integers, as a bit mask."""
    mask = lambda fields: sum(1 << p for p in specs.int_positions(fields))
    masks = {name: mask(layout.fields) for name, layout in specs.LAYOUTS.items()}
    masks |= {
        "damage": mask(specs.DAMAGE_SHORT),
        "damage_long": mask(specs.DAMAGE_LONG),
        "heal": mask(specs.HEAL_SHORT),
        "heal_long": mask(specs.HEAL_LONG),
        "miss": mask(specs.MISS),
        "energize": 0b10 if fix_power_type else 0,
        "world_marker": 0b11,
    }
    return masks


def _pick(key: str, values: dict[str, int]) -> str:
    """Integer by name, 0 when not listed; names with one value share one test."""
    by_value: dict[int, list[str]] = {}
    for name, value in values.items():
        if value:
            by_value.setdefault(value, []).append(name)
    cases = " ".join(
        f"when {key} in ({', '.join(map(literal, names))}) then {value}"
        for value, names in by_value.items()
    )
    return f"case {cases} else 0 end"


def _raw(i: int) -> str:
    return f"get(cols, base + {i})"


def _int(i: int) -> str:
    return f"get(ints, {i})"


def _bind(f: Field, number: str | None = None) -> str:
    """Field of the payload; integers come from the shared column ``ints``."""
    raw = _raw(f.position)
    number = number or _int(f.position)
    present = f"{raw} is not null"
    zero = f"coalesce({number}, 0L)"
    return {
        "raw": raw,
        "text": unquote(raw),
        "unquote_both": f"trim(BOTH '\\'\"' FROM {raw})",
        "int": number,
        "int0": f"if({present}, {zero}, null)",
        "int0_unless_nil": f"if({raw} <> 'nil', {zero}, null)",
        "bool": f"({number} <> 0)",
        "bool0": f"if({present}, {zero} <> 0, null)",
        "float": as_float(raw),
        "power": f"if({present}, {flags.power_type_name(zero)}, null)",
        "base10": base10_int(raw),
    }[f.kind]


def _struct(condition: str, fields: dict[str, str]) -> str:
    """STRUCT of the fields where the condition holds, else null."""
    inner = ", ".join(f"{literal(name)}, {expr}" for name, expr in fields.items())
    return f"case when {condition} then named_struct({inner}) end"


def _two_forms(long: tuple[Field, ...], short: tuple[Field, ...]) -> dict[str, str]:
    by_name = {f.name: f for f in short}
    other = lambda name: _bind(by_name[name]) if name in by_name else "null"
    return {f.name: f"if(is_long, {_bind(f)}, {other(f.name)})" for f in long}


def _own_family(name: str, fields: tuple[Field, ...]) -> Column:
    """A user's layout. Its integers are not among the shared columns."""
    raw = lambda f: F.expr(_raw(f.position))
    made = [
        (
            F.when(raw(f).isNotNull(), f.kind(raw(f)))
            if callable(f.kind)
            else F.expr(_bind(f, as_int(_raw(f.position))))
        ).alias(f.name)
        for f in fields
    ]
    return F.when(F.col("fam") == name, F.struct(*made)).alias(name)


# Names of the four flag fields. The rule sits in a lambda, so it is there once and not four
# times in the generated code.
ACTOR_FLAGS = (
    "transform(transform(array(get(cols, 3), get(cols, 4), get(cols, 7), get(cols, 8)), "
    f"x -> {as_flag_int('x')}), f -> {flags.unit_flag_names('f')})"
)


def decode_actors() -> str:
    """STRUCT expression of the source and target unit from ``cols`` and ``flag_names``."""
    fields = []
    for side, first, flag in (("source", 1, 0), ("dest", 5, 2)):
        fields += [
            f"'{side}GUID', get(cols, {first})",
            f"'{side}Name', {unquote(f'get(cols, {first + 1})')}",
            f"'{side}Flags', get(flag_names, {flag})",
            f"'{side}RaidFlags', get(flag_names, {flag + 1})",
        ]
    return f"named_struct({', '.join(fields)})"


def _families(fix_power_type: bool) -> dict[str, str]:
    """One STRUCT expression per payload family."""
    miss = {f.name: _bind(f) for f in specs.MISS}
    miss["amountMissed"] = f"coalesce(nullif({_int(2)}, 0L), {_int(4)})"
    energize = {f.name: _bind(f) for f in specs.ENERGIZE}
    power = flags.power_type_name(f"coalesce({_int(1)}, 0L)") if fix_power_type else "'unknown'"
    energize["power_type"] = f"if(rest_n > 1, {power}, null)"
    long_n = len(specs.DAMAGE_LONG)
    damage = _two_forms(specs.DAMAGE_LONG, specs.DAMAGE_SHORT)
    damage["schoolNames"] = flags.school_names(f"if(is_long, {_int(4)}, {_int(2)})")
    damage["extra"] = (
        f"if(is_long and rest_n > {long_n}, "
        f"slice(cols, base + {long_n + 1}, greatest(rest_n - {long_n}, 0)), null)"
    )
    out = {
        "damage": _struct("fam = 'damage'", damage),
        "heal": _struct("fam = 'heal'", _two_forms(specs.HEAL_LONG, specs.HEAL_SHORT)),
        "miss": _struct("fam = 'miss'", miss),
        "energize": _struct("fam = 'energize'", energize),
    }
    for name, layout in specs.LAYOUTS.items():
        fields = {f.name: _bind(f) for f in layout.fields}
        names = f"fam = '{name}'"
        if name == "aura_refresh":
            continue
        if name == "aura":
            names = "fam in ('aura', 'aura_refresh')"
        enough = f"{names} and rest_n >= {layout.min_fields}"
        if name in ("encounter", "arena_end"):
            enough += "".join(
                f" and {_bind(f)} is not null" for f in layout.fields if f.kind == "base10"
            )
        if name == "arena_start":
            fields["extraFields"] = (
                "if(rest_n > 4, "
                f"transform(slice(cols, 6, greatest(n_fields - 5, 0)), x -> {unquote('x')}), null)"
            )
        out[name] = _struct(enough, fields)
    out["world_marker"] = _struct(
        "fam = 'world_marker' and (rest_n = 1 or rest_n >= 4)",
        {
            "removed": "if(rest_n = 1, true, null)",
            "flag": f"if(rest_n = 1, {_raw(0)}, null)",
            "mapId": f"if(rest_n >= 4, coalesce({_int(0)}, 0L), null)",
            "markerId": f"if(rest_n >= 4, coalesce({_int(1)}, 0L), null)",
            "x": f"if(rest_n >= 4, {as_float(_raw(2), 0.0)}, null)",
            "y": f"if(rest_n >= 4, {as_float(_raw(3), 0.0)}, null)",
            "z": f"if(rest_n > 4, {as_float(_raw(4), 0.0)}, null)",
        },
    )
    return out


def _first_bad_int(positions: list[int]) -> str:
    """Message on the first payload field that is no decimal integer, else null."""
    fields = ", ".join(_raw(i) for i in positions)
    bad = f"filter(array({fields}), x -> {base10_int('x')} is null)"
    return f"get(transform({bad}, x -> concat({literal(BAD_INT)}, {quoted_text('x')})), 0)"


def _base10_positions(family: str) -> list[int]:
    return [f.position for f in specs.LAYOUTS[family].fields if f.kind == "base10"]


_MARKER_BAD = "fam = 'world_marker' and rest_n <> 1 and rest_n < 4"


def _cases(value_of, default: str = "null") -> str:
    """CASE over the families with too few fields, by a value of their layout."""
    cases = " ".join(
        f"when fam = '{name}' and rest_n < {layout.min_fields} then {literal(value_of(layout))}"
        for name, layout in specs.LAYOUTS.items()
        if value_of(layout)
    )
    return f"case {cases} else {default} end"


def _warning(on_drop: str, on_marker: str, on_encounter: str, value_of) -> str:
    return f"""case when dropped then {literal(on_drop)}
        when {_MARKER_BAD} then {literal(on_marker)}
        when encounter_bad is not null then {on_encounter}
        else {_cases(value_of)} end"""


def _warning_label() -> str:
    return _warning("SPELL_SUMMON", "WORLD_MARKER", "'ENCOUNTER'", lambda x: x.warning_label)


def _stage(routed: DataFrame, fix_power_type: bool) -> DataFrame:
    """Where the payload starts, whether the line can be read, and its integers."""
    has_actors = "route in ('special', 'table')"
    int_n = 1 + max(specs.int_positions(specs.DAMAGE_LONG))
    long_from = _pick(
        "family", {"damage": specs.DAMAGE_LONG_FROM, "heal": specs.HEAL_LONG_FROM}
    )
    layout = "if(is_long, concat(fam, '_long'), fam)"
    return (
        routed.selectExpr(
            "*",
            f"coalesce(event = 'SPELL_SUMMON' and n_fields < {SUMMON_FIELDS} "
            "and header_error is null, false) as dropped",
            f"""case when prefix = 'line' then 1
                     when prefix in ('spell', 'enchant') and {_WHOLE} then {ACTOR_FIELDS + 3}
                     when prefix = 'environment' then {ACTOR_FIELDS + 1}
                     else {ACTOR_FIELDS} end as base""",
            f"{long_from} as long_from",
        )
        .selectExpr(
            "*",
            f"""case when header_error is not null then header_error
                     when dropped then null
                     when prefix = 'enchant' and n_fields < {ACTOR_FIELDS}
                       then concat('Incomplete line for ', event)
                     when {has_actors} and n_fields < {ACTOR_FIELDS}
                       then concat('Invalid format for ', event, ': insufficient columns')
                     end as line_error""",
            "greatest(n_fields - base, 0) as rest_n",
        )
        .selectExpr(
            "*",
            "long_from > 0 and rest_n >= long_from as is_long",
            f"""coalesce(line_error is null and not dropped
                 and ((prefix = 'environment' and n_fields <= {ACTOR_FIELDS})
                      or (family = 'cast_failed' and rest_n < 1)), false) as fatal""",
        )
        .selectExpr("*", "line_error is null and not dropped and not fatal as usable")
        .selectExpr(
            "*",
            "if(usable, family, null) as fam",
            "if(usable, prefix, null) as pre",
        )
        .selectExpr("*", f"{_pick(layout, _int_masks(fix_power_type))} as int_mask")
        .selectExpr(
            "*",
            f"""if(int_mask = 0, null, transform(slice(cols, base + 1, {int_n}),
                (x, i) -> if(int_mask & shiftleft(1, i) <> 0, {as_int('x')}, null))) as ints""",
            f"if(usable and {has_actors}, {ACTOR_FLAGS}, null) as flag_names",
            # spellId and spellSchool
            f"""if(pre = 'spell' and {_WHOLE},
                transform(array(get(cols, 9), get(cols, 11)), x -> {as_int('x', 0)}), null)
                as spell_ints""",
        )
    )


def decode_events(
    routed: DataFrame, registry: RouteRegistry, *, fix_power_type: bool = False
) -> DataFrame:
    """Add actors, one nullable STRUCT per payload family, and the line's status."""
    staged = _stage(routed, fix_power_type)
    encounter_bad = (
        "case when fam = 'encounter' and rest_n >= 4 "
        f"then {_first_bad_int(_base10_positions('encounter'))} end"
    )
    arena_bad = (
        "case when fam = 'arena_end' and rest_n >= 4 "
        f"then {_first_bad_int(_base10_positions('arena_end'))} end"
    )
    staged = staged.selectExpr(
        "*", f"{encounter_bad} as encounter_bad", f"{arena_bad} as arena_bad"
    ).selectExpr("*", f"{_warning_label()} as warning_label")
    spell_short = f"pre = 'spell' and not ({_WHOLE})"
    enchant_fields = {
        "enchantName": unquote("get(cols, 9)"),
        "itemId": as_int("get(cols, 10)", 0),
        "itemName": unquote("get(cols, 11)"),
    }
    spell_fields = {
        "spellId": "get(spell_ints, 0)",
        "spellName": unquote("get(cols, 10)"),
        "spellSchool": "get(spell_ints, 1)",
        "spellSchoolNames": flags.school_names("get(spell_ints, 1)"),
    }
    error = f"""case
        when {_MARKER_BAD} then {literal(MARKER_ERROR)}
        when fam = 'zone' and rest_n < 3
          then concat('Invalid format for ZONE_CHANGE: ', {quoted_list(_PAYLOAD)})
        when encounter_bad is not null then concat('Failed to parse ENCOUNTER data: ', encounter_bad)
        else coalesce({_cases(lambda x: x.error)}, if({spell_short}, {literal(SPELL_ERROR)}, null))
        end"""
    keeps = " or ".join(
        f"(fam = '{name}' and rest_n < {layout.min_fields})"
        for name, layout in specs.LAYOUTS.items()
        if layout.keeps_data
    )

    reason = _warning(SUMMON_REASON, MARKER_ERROR, "encounter_bad", lambda x: x.warning_reason)
    message = _warning(
        SUMMON_MESSAGE, MARKER_ERROR, "encounter_bad",
        lambda x: x.error if x.warning_label else None,
    )
    kept = [c for c in routed.columns if c not in _INTERNAL]
    families = [f"{expr} as {name}" for name, expr in _families(fix_power_type).items()]
    texts = [
        """case when raw = '' then 'blank' when line_error is not null then 'malformed' when dropped then 'dropped'
                when fatal then 'fatal' when arena_bad is not null then 'malformed'
                else coalesce(combatant_status, 'ok') end as status""",
        f"""coalesce(line_error, if(fatal, {literal(INDEX_ERROR)}, null), arena_bad,
                combatant_error) as status_error""",
        f"if(usable and route in ('special', 'table'), {decode_actors()}, null) as actors",
        f"{_struct(f'''pre = 'spell' and {_WHOLE}''', spell_fields)} as spell",
        "if(pre = 'environment', get(cols, 9), null) as environmentalType",
        f"{_struct(f'''pre = 'enchant' and {_WHOLE}''', enchant_fields)} as enchant",
        *families,
    ]
    tail = [
        f"{error} as error",
        f"if({keeps} or ({_MARKER_BAD}), {_PAYLOAD}, null) as error_cols",
        f"if({spell_short}, slice(cols, {ACTOR_FIELDS + 1}, greatest(n_fields - {ACTOR_FIELDS}, 0)),"
        " null) as raw_cols",
        "if(usable and route = 'unparsed', slice(cols, 2, greatest(n_fields - 1, 0)), null)"
        " as unparsed_params",
        "warning_label",
        f"{reason} as warning_reason",
        f"{message} as warning_message",
        "if(warning_label is not null, "
        f"slice(if(dropped, cols, {_PAYLOAD}), 1, {SAMPLE}), null) as warning_cols",
        "combatant",
    ]
    return staged.select(
        *kept,
        *map(F.expr, texts),
        *[_own_family(name, fields) for name, fields in registry.custom.items()],
        *map(F.expr, tail),
    )


def payload(events: DataFrame, family: str, *keep: str) -> DataFrame:
    """Rows that hold the family, its fields as columns next to the ``keep`` columns.

    ``inline`` evaluates the struct once per row, where ``select("family.*")`` would
    repeat its rule for every field.
    """
    return events.select(*keep, F.inline(F.array_compact(F.array(family))))


# Columns of the stages before, left out of the result.
_INTERNAL = (
    "cols",
    "rest",
    "year_hint",
    "header_error",
    "prefix",
    "family",
    "combatant",
    "combatant_status",
    "combatant_error",
)


def parse_events(
    lines: DataFrame,
    *,
    log_tz: str = "UTC",
    now: datetime | None = None,
    default_year: int = clock.DEFAULT_YEAR,
    extended_routes: bool = False,
    fix_power_type: bool = False,
    quote_aware: bool = False,
    registry: RouteRegistry | None = None,
) -> DataFrame:
    """``lines`` (file, line_no, raw) to the wide ``events`` table.

    Stateless projections only: it runs on batch and streaming input alike. Select what
    you need and the rest is never computed.
    """
    registry = registry or RouteRegistry(extended=extended_routes)
    headed = parse_header(
        lines, log_tz=log_tz, now=now, default_year=default_year, quote_aware=quote_aware
    )
    routed = with_combatant(route_events(headed, registry))
    return decode_events(routed, registry, fix_power_type=fix_power_type)
