"""Nested character records: stats, talents, powers, gear, auras and PvP standing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewright.functions.nested import json_items, literal_json, split_nested, tidy_literal
from linewright.functions.scalars import base10_int
from linewright.operators.routes import COMBATANT

# The integer stats in line order.
STATS = [
    "strength",
    "agility",
    "stamina",
    "intellect",
    "dodge",
    "parry",
    "block",
    "crit_melee",
    "crit_ranged",
    "crit_spell",
    "speed",
    "lifesteal",
    "haste_melee",
    "haste_ranged",
    "haste_spell",
    "avoidance",
    "mastery",
    "versatility_damage_done",
    "versatility_healing_done",
    "versatility_damage_taken",
    "armor",
    "spec_id",
]
PVP_STATS = ["honor_level", "season", "rating", "tier"]

# Token positions, the event name being token 0.
_GUID, _FACTION, _FIRST_STAT = 1, 2, 3
_CLASS = _FIRST_STAT + len(STATS)
_PVP_TALENTS = _CLASS + 1
_POWERS = _CLASS + 2

_INT = r"r'^-?[0-9]+$'"
_INT_LIST = r"r'^\[(?:-?[0-9]+(?:,-?[0-9]+)*)?\]$'"
_TRIPLES = r"r'^\[(?:\((?:-?[0-9]+,){2}-?[0-9]+,?\),?)*\]$'"
_NO_INTS = "cast(array() as array<bigint>)"


def _ints(json: str) -> str:
    """A lone integer or a flat list of integers, else null."""
    return (
        f"(case when {json} rlike {_INT_LIST} then from_json({json}, 'array<bigint>') "
        f"when {json} rlike {_INT} then array(try_cast({json} as bigint)) end)"
    )


def _lists(json: str) -> str:
    """Items of a list of lists as text; null when any item is no list."""
    return f"from_json({json}, 'array<array<string>>')"


def _literals(tokens: str) -> str:
    return f"transform({tokens}, x -> if(x = '', '[]', {literal_json(tidy_literal('x'))}))"


def _at(items: str, i: int) -> str:
    return f"try_cast(get({items}, {i}) as bigint)"


def _pairs(values: str, first: str, second: str, keep_odd: bool) -> str:
    whole = "" if keep_odd else " and i + 1 < size(w)"
    # A lambda around, so that the values are read once and not again for every pair.
    return (
        f"get(transform(array({values}), w -> filter(transform(w, (v, i) -> if(i % 2 = 0{whole}, "
        f"named_struct('{first}', v, '{second}', get(w, i + 1)), null)), "
        "p -> p is not null)), 0)"
    )


def _records(lists: str, *names: str) -> str:
    fields = ", ".join(f"'{name}', {_at('t', i)}" for i, name in enumerate(names))
    return f"transform({lists}, t -> named_struct({fields}))"


# The faults of a record in reading order: condition, kind, text.
_FAULTS = [
    (f"ct_n < {_CLASS}", "malformed", "incomplete line: stats"),
    ("exists(ct_stats, x -> x is null)", "malformed", "stat is no integer"),
    (f"ct_n < {_POWERS}", "malformed", "incomplete line: talents"),
    ("ct_pvp is null", "malformed", "PvP talents malformed"),
    ("ct_pvp_ints is null", "fatal", "PvP talents nested"),
    ("ct_class is null", "malformed", "class talents malformed"),
    (
        "ct_new_form and (ct_nodes is null or exists(ct_nodes, x -> size(x) < 3))",
        "fatal", "class talent is no triple",
    ),
    ("not ct_new_form and ct_ids is null", "fatal", "class talents no list"),
    (
        "ct_powers_tidy is not null and ct_powers is null",
        "malformed", "expansion powers malformed",
    ),
    ("ct_kind = 'shadowlands' and ct_traits is null", "fatal", "soulbind traits nested"),
    (
        "ct_kind = 'shadowlands' and "
        "(ct_conduits is null or exists(ct_conduits, x -> size(x) < 2))",
        "fatal", "conduit is no pair",
    ),
    ("ct_n <= ct_gear_at", "malformed", "incomplete line: equipment"),
    (f"ct_gear is null or ct_gear rlike {_INT}", "malformed", "equipment malformed"),
    ("ct_gear_fault = 'malformed'", "malformed", "equipment entry too short"),
    ("ct_gear_fault = 'fatal'", "fatal", "equipment entry is no list"),
    ("ct_tail_n between 1 and 4", "malformed", "incomplete line: PvP stats"),
    (
        "ct_tail_n >= 5 and exists(ct_standing, x -> x is null)",
        "malformed", "PvP stat is no integer",
    ),
    ("ct_faction is null", "malformed", "faction is no integer"),
]


def _record() -> str:
    """The nested record, built from the staged columns."""
    stats = ", ".join(f"'{s}', get(ct_stats, {i})" for i, s in enumerate(STATS))
    standing = ", ".join(f"'{s}', get(ct_standing, {i})" for i, s in enumerate(PVP_STATS))
    soul = "ct_kind = 'shadowlands'"
    entry_ints = lambda i: f"coalesce({_ints(f'get(e, {i})')}, {_NO_INTS})"
    gear = (
        f"transform(ct_entries, e -> named_struct('item_id', {_at('e', 0)}, "
        f"'item_level', {_at('e', 1)}, 'enchants', {entry_ints(2)}, "
        f"'bonus_list', {entry_ints(3)}, "
        f"'gems', {_pairs(entry_ints(4), 'id', 'item_level', True)}))"
    )
    parts = "if(ct_auras = '', cast(array() as array<string>), transform(split(ct_auras, ','), x -> trim(x)))"
    auras = (
        f"transform({_pairs(parts, 'caster_guid', 'spell_id', False)}, a -> named_struct("
        f"'caster_guid', a.caster_guid, 'spell_id', a.spell_id, "
        f"'spell_id_int', {base10_int('a.spell_id')}))"
    )
    artifact = _pairs("from_json(ct_powers, 'array<bigint>')", "trait_id", "rank", False)
    powers = (
        f"named_struct('kind', ct_kind, "
        f"'soulbind_id', if({soul}, {_at('ct_items', 0)}, null), "
        f"'covenant_id', if({soul}, {_at('ct_items', 1)}, null), "
        f"'anima_powers', if({soul}, {_records('ct_anima', 'spell_id', 'maw_power_id', 'count')}, null), "
        f"'soulbind_traits', if({soul}, ct_traits, null), "
        f"'conduits', if({soul}, {_records('ct_conduits', 'id', 'item_level')}, null), "
        f"'artifact_traits', if(ct_kind = 'artifact', {artifact}, null), "
        "'raw', if(ct_kind = 'other', ct_powers, null))"
    )
    return (
        f"named_struct('player', named_struct('guid', get(ct, {_GUID}), 'faction', ct_faction), "
        f"'stats', named_struct({stats}), "
        "'class_talents', named_struct('kind', if(ct_new_form, 'nodes', 'ids'), 'ids', ct_ids, "
        f"'nodes', {_records('ct_nodes', 'talent_id', 'spell_id', 'rank')}), "
        f"'pvp_talents', ct_pvp_ints, 'expansion_powers', {powers}, 'equipment', {gear}, "
        f"'interesting_auras', if(ct_tail_n >= 5, {auras}, slice({auras}, 1, 0)), "
        f"'pvp_stats', named_struct({standing}))"
    )


def _stages() -> list[dict[str, str]]:
    """The reading of a record step by step; a step sees the names of the steps before."""
    numbers = lambda first, n: f"transform(slice(ct, {first}, {n}), x -> {base10_int('x')})"
    repaired = f"regexp_replace(get(ct, {_CLASS}), r'^\\[,\\s*', '[')"
    powers_token = f"get(ct, {_POWERS})"
    inner = r"regexp_replace(ct_powers_tidy, r'^\[|,?\]$', '')"
    shape = lambda i: f"get(ct_shape, {i})"
    soulbound = (
        f"size(ct_shape) >= 5 and {shape(0)} rlike {_INT} and {shape(1)} rlike {_INT} "
        f"and {shape(2)} rlike {_TRIPLES} and startswith({shape(3)}, '[') "
        f"and startswith({shape(4)}, '[')"
    )
    even = f"ct_powers rlike {_INT_LIST} and (ct_powers = '[]' or size(ct_items) % 2 = 0)"
    entry = "from_json(g, 'array<string>')"
    fault_of_entry = (
        f"get(transform(array({entry}), e -> case when not startswith(g, '[') then 'fatal' when size(e) < 2 then 'malformed' "
        f"when not (get(e, 0) rlike {_INT} and get(e, 1) rlike {_INT}) then 'fatal' end), 0)"
    )
    faults = " ".join(
        f"when {cond} then named_struct('kind', '{kind}', 'text', '{text}')"
        for cond, kind, text in _FAULTS
    )
    return [
        {
            "ct_n": "size(ct)",
            "ct_stats": numbers(_FIRST_STAT + 1, len(STATS)),
            "ct_faction": base10_int(f"get(ct, {_FACTION})"),
            "ct_new_form": f"startswith(get(ct, {_CLASS}), '[')",
            "ct_talents": _literals(f"array(get(ct, {_PVP_TALENTS}), {repaired})"),
            "ct_powers_tidy": f"if(startswith({powers_token}, '['), {tidy_literal(powers_token)}, null)",
        },
        {
            "ct_pvp": "get(ct_talents, 0)",
            "ct_class": "get(ct_talents, 1)",
            "ct_powers": literal_json("ct_powers_tidy"),
            "ct_has_powers": r"ct_powers_tidy is not null and not ct_powers_tidy rlike r'^\[\('",
        },
        {
            "ct_pvp_ints": _ints("ct_pvp"),
            "ct_nodes": f"if(ct_new_form, {_lists('ct_class')}, null)",
            "ct_ids": f"if(not ct_new_form and not ct_class rlike {_INT}, {_ints('ct_class')}, null)",
            "ct_gear_at": f"if(ct_has_powers, {_POWERS + 1}, {_POWERS})",
            "ct_shape": f"if(ct_has_powers, {split_nested(inner)}, null)",
            "ct_items": f"if(ct_has_powers, {json_items('ct_powers')}, null)",
        },
        {
            "ct_kind": f"case when not ct_has_powers then 'none' when {soulbound} then 'shadowlands' "
            f"when {even} then 'artifact' else 'other' end",
            "ct_gear": f"get({_literals('array(get(ct, ct_gear_at))')}, 0)",
            "ct_anima": _lists("get(ct_items, 2)"),
            "ct_traits": _ints("get(ct_items, 3)"),
            "ct_conduits": _lists("get(ct_items, 4)"),
            "ct_tail_n": "ct_n - ct_gear_at - 1",
            "ct_standing": numbers("ct_gear_at + 3", len(PVP_STATS)),
            "ct_auras": r"regexp_replace(get(ct, ct_gear_at + 1), r'^\[(.*)\]$', '$1')",
        },
        {"ct_gear_items": json_items("ct_gear")},
        {
            "ct_entries": f"transform(ct_gear_items, g -> {entry})",
            "ct_gear_fault": f"get(filter(transform(ct_gear_items, g -> {fault_of_entry}), "
            "x -> x is not null), 0)",
        },
        {"ct_fault": f"case {faults} end"},
    ]


def _read(text: str) -> str:
    """The steps as nested lambdas over one struct.

    Few rows are combatants. As lambdas the rules stay one expression of fixed size, which
    a pushed-down filter on the status cannot multiply, and stay out of the code that
    Spark generates for the other rows.
    """
    known = ["ct"]
    own = lambda rule: re.sub(r"\bct(?:_[a-z_]+)?\b", r"s.\g<0>", rule)
    expr = f"array(named_struct('ct', {split_nested(text)}))"
    for stage in _stages():
        fields = [f"'{n}', s.{n}" for n in known] + [f"'{n}', {own(r)}" for n, r in stage.items()]
        expr = f"transform({expr}, s -> named_struct({', '.join(fields)}))"
        known += stage
    result = (
        f"named_struct('record', if(s.ct_fault is null, {own(_record())}, null), "
        "'status', coalesce(s.ct_fault.kind, 'ok'), 'error', s.ct_fault.text)"
    )
    return f"get(transform({expr}, s -> {result}), 0)"


def with_combatant(routed: DataFrame) -> DataFrame:
    """Add ``combatant`` STRUCT plus ``combatant_status`` and ``combatant_error``.

    All three are null on other events. The checks run in the order the record is read,
    so the first fault decides between a malformed and a fatal line.
    """
    mine = f"event = '{COMBATANT}' and header_error is null"
    return routed.selectExpr("*", f"if({mine}, {_read('rest')}, null) as ct").selectExpr(
        *routed.columns,
        "ct.record as combatant",
        "ct.status as combatant_status",
        "ct.error as combatant_error",
    )


def parse_combatants(events: DataFrame) -> DataFrame:
    """One row per good combatant line with its nested record."""
    kept = [c for c in ("file", "line_no", "event_time", "timestamp", "lh") if c in events.columns]
    mine = events.where(F.col("event") == COMBATANT)
    return mine.select(*kept, F.inline(F.array_compact(F.array("combatant"))))
