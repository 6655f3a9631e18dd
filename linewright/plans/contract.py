"""Contract queries: one per operator, each over whole tables, with an independent answer.

The Spark side renders log lines from the tables and parses them back. The SQL side
computes what must come out straight from the source columns and never parses text.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import linewright as L
from linewright import Field
from linewright.functions import clock, flags, scalars
from linewright.operators.sizing import settle
from linewright.plans import render as R
from linewright.functions.nested import literal_json, split_nested, tidy_literal
from linewright.sources.keys import key_of_url, keys_of_json, log_file_name, union_keys
from linewright.sources.lines import smallest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def _events(spark: SparkSession, sf: str, with_faults: bool = False) -> DataFrame:
    return R.event_lines(R.table(spark, sf, "events"), with_faults=with_faults)


def _parsed(spark: SparkSession, sf: str, with_faults: bool = False, **options) -> DataFrame:
    return L.parse_events(_events(spark, sf, with_faults), **options)


# ---- SQL side: what a rendered event must give ----

_ARITY = [21, 16, 13, 14, 16, 15, 19, 13, 12, 15, 18, 12, 5, 5, 5, 12]
_ROUTES = ["table"] * 9 + ["unparsed", "table", "special"] + ["standalone"] * 3 + ["table"]
_AMOUNT = "cast(round(value * 100) as bigint)"


def _by_slot(values: list, quote: bool = True) -> str:
    q = "'" if quote else ""
    cases = " ".join(f"when {i} then {q}{v}{q}" for i, v in enumerate(values))
    return f"case event_id % 16 {cases} end"


_EVENT = _by_slot(R.SLOTS)
_N_FIELDS = _by_slot(_ARITY, quote=False)


# The names once more, written out for the SQL side only, so that a wrong one in the engine shows.
_FLAG_NAMES = [
    ("AFFILIATION_MINE", 1), ("AFFILIATION_PARTY", 2), ("AFFILIATION_RAID", 4), ("AFFILIATION_OUTSIDER", 8),
    ("REACTION_FRIENDLY", 16), ("REACTION_NEUTRAL", 32), ("REACTION_HOSTILE", 64),
    ("CONTROL_PLAYER", 256), ("CONTROL_NPC", 512),
    ("TYPE_PLAYER", 1024), ("TYPE_NPC", 2048), ("TYPE_PET", 4096), ("TYPE_GUARDIAN", 8192), ("TYPE_OBJECT", 16384),
    ("TARGET", 65536), ("FOCUS", 131072), ("MAINTANK", 262144), ("MAINASSIST", 524288), ("NONE", 8388608),
]
_SCHOOL_NAMES = [("PHYSICAL", 1), ("HOLY", 2), ("FIRE", 4), ("NATURE", 8), ("FROST", 16), ("SHADOW", 32), ("ARCANE", 64)]
_POWER_NAMES = {
    -2: "health", 0: "mana", 1: "rage", 2: "focus", 3: "energy", 4: "combo points", 5: "runes", 6: "runic power",
    7: "soul shards", 8: "lunar power", 9: "holy power", 10: "alternate", 11: "maelstrom", 12: "chi", 13: "insanity",
    16: "arcane charges", 17: "fury", 18: "pain", 19: "essence",
}
_STAT_NAMES = [
    "strength", "agility", "stamina", "intellect", "dodge", "parry", "block", "crit_melee", "crit_ranged", "crit_spell",
    "speed", "lifesteal", "haste_melee", "haste_ranged", "haste_spell", "avoidance", "mastery",
    "versatility_damage_done", "versatility_healing_done", "versatility_damage_taken", "armor",
]


def _names_sql(value: str, members: list[tuple[str, int]]) -> str:
    parts = ", ".join(f"case when ({value} & {bit}) <> 0 then '{name}' end" for name, bit in members)
    return f"concat_ws('|', {parts})"


def _hex_sql(value: str) -> str:
    return f"'0x' || lower(hex({value}))"


_SRC_FLAGS = "((event_id * 7919) % 1048576)"
_DST_FLAGS = "((event_id * 104729) % 16777216)"

# ---- profile, routing, header ----

_PROFILE_SQL = f"""select event, count(*) as n, min(n_fields) as min_fields, max(n_fields) as max_fields
    from (select {_EVENT} as event, {_N_FIELDS} as n_fields from events) group by event"""


@query("event_profile", _PROFILE_SQL)
def _(spark, sf):
    return L.event_profile(L.parse_header(_events(spark, sf)))


@query(
    "event_profile_running",
    f"""select *, cast(sum(n) over (order by event) as bigint) as running,
        cast(sum(n) over () as bigint) as total from ({_PROFILE_SQL})""",
)
def _(spark, sf):
    return L.event_profile(L.parse_header(_events(spark, sf)), running=True)


@query(
    "route_classify",
    f"""select {_EVENT} as event, {_by_slot(_ROUTES)} as route, count(*) as n
        from events group by 1, 2""",
)
def _(spark, sf):
    routed = L.route_events(L.parse_header(_events(spark, sf)), L.RouteRegistry())
    return routed.groupBy("event", "route").agg(F.count(F.lit(1)).alias("n"))


_ACTORS_SQL = f"""'Player-' || event_id || '|"Src ' || event_id % 100 || '"|' || {_hex_sql(_SRC_FLAGS)}
    || '|' || {_hex_sql('(event_id % 16)')} || '|Creature-' || event_id % 977 || '|"Dst ' || event_id % 50
    || '"|' || {_DST_FLAGS} || '|nil'"""


@query(
    "unparsed_params",
    f"""select event_id + 1 as line_no, {_ACTORS_SQL} || '|' || event_id % 1000 || '|"Spell '
        || event_id % 1000 || '"|' || {_hex_sql('(event_id % 128)')} || '|ABSORB|nil|' || {_AMOUNT} as params
        from events where event_id % 16 = 9""",
)
def _(spark, sf):
    parsed = _parsed(spark, sf).where("unparsed_params is not null")
    return parsed.selectExpr("line_no", "array_join(unparsed_params, '|') as params")


@query(
    "extended_routes",
    f"""select event_id + 1 as line_no, 'ABSORB' as miss_type, {_AMOUNT} as missed
        from events where event_id % 16 = 9""",
)
def _(spark, sf):
    missed = L.payload(_parsed(spark, sf, extended_routes=True), "miss", "line_no")
    return missed.selectExpr("line_no", "missType as miss_type", "amountMissed as missed")


@query(
    "parse_header",
    f"""select event_id + 1 as line_no, epoch_us(ts) as micros, {_EVENT} as event,
        {_N_FIELDS} as n_fields from events""",
)
def _(spark, sf):
    return L.parse_header(_events(spark, sf)).selectExpr(
        "line_no", "unix_micros(event_time) as micros", "event", "n_fields"
    )


_DAY_TIME = """((o_orderkey % 24) * 3600 + (o_orderkey % 60) * 60 + o_orderkey % 59) * 1000000
    + (o_orderkey % 1000) * 1000"""


@query(
    "year_rules",
    f"""select o_orderkey as line_no, case
          when o_orderkey % 5 < 3 then epoch_us(o_orderdate) + {_DAY_TIME}
          when o_orderkey % 5 = 3 and not (month(o_orderdate) = 2 and day(o_orderdate) = 29)
            then epoch_us(make_timestamp(2023, month(o_orderdate), day(o_orderdate), 0, 0, 0)) + {_DAY_TIME}
          end as micros from orders""",
)
def _(spark, sf):
    """Year from the file name, four digits, two digits, the default, three digits (bad)."""
    orders = R.table(spark, sf, "orders")
    date = """concat(month(o_orderdate), '/', day(o_orderdate), case o_orderkey % 5
        when 1 then concat('/', year(o_orderdate))
        when 2 then concat('/', year(o_orderdate) % 100)
        when 4 then concat('/1', year(o_orderdate) % 10, '0') else '' end)"""
    time = """concat(o_orderkey % 24, ':', o_orderkey % 60, ':', o_orderkey % 59, '.',
        lpad(o_orderkey % 1000, 3, '0'))"""
    file = "if(o_orderkey % 5 = 0, concat(year(o_orderdate), '_log.txt'), 'log.txt')"
    rendered = R.lines(orders, file, "o_orderkey", f"concat({date}, ' ', {time})", "'UNIT_DIED'")
    return L.parse_header(rendered).selectExpr("line_no", "unix_micros(event_time) as micros")


@query(
    "tz_strip",
    """select event_id + 1 as line_no, epoch_us(ts) as micros,
        case event_id % 4 when 1 then '-5' when 2 then '+0530' when 3 then '+01:00' end as tz_offset
        from events""",
)
def _(spark, sf):
    offset = "case event_id % 4 when 1 then '-5' when 2 then '+0530' when 3 then '+01:00' else '' end"
    time = f"concat({R.TIME.format('ts')}, {offset})"
    rows = R.table(spark, sf, "events")
    rendered = R.lines(rows, "'2024.txt'", "event_id + 1", time, "'UNIT_DIED'")
    return L.parse_header(rendered).selectExpr(
        "line_no", "unix_micros(event_time) as micros", "tz_offset"
    )


# ---- actors, flags, scalars ----


@query(
    "actors",
    f"""select event_id + 1 as line_no, 'Player-' || event_id as source, 'Src ' || event_id % 100 as source_name,
        {_names_sql(_SRC_FLAGS, _FLAG_NAMES)} as source_flags,
        {_names_sql('(event_id % 16)', _FLAG_NAMES)} as source_raid_flags,
        'Creature-' || event_id % 977 as dest, 'Dst ' || event_id % 50 as dest_name,
        {_names_sql(_DST_FLAGS, _FLAG_NAMES)} as dest_flags, '' as dest_raid_flags
        from events where event_id % 16 not in (9, 12, 13, 14)""",
)
def _(spark, sf):
    found = L.payload(_parsed(spark, sf), "actors", "line_no")
    join = lambda c: f"array_join({c}, '|')"
    return found.selectExpr(
        "line_no",
        "sourceGUID as source",
        "sourceName as source_name",
        join("sourceFlags") + " as source_flags",
        join("sourceRaidFlags") + " as source_raid_flags",
        "destGUID as dest",
        "destName as dest_name",
        join("destFlags") + " as dest_flags",
        join("destRaidFlags") + " as dest_raid_flags",
    )


@query(
    "unit_flags",
    f"select event_id, {_names_sql(_DST_FLAGS, _FLAG_NAMES)} as names from events",
)
def _(spark, sf):
    rows = R.table(spark, sf, "events").selectExpr(
        "event_id", R.hex_of("(event_id * 104729) % 16777216") + " as text"
    )
    names = flags.unit_flag_names(scalars.as_flag_int("text"))
    return rows.selectExpr("event_id", f"array_join({names}, '|') as names")


@query(
    "school_flags",
    f"select event_id, {_names_sql('(event_id % 256)', _SCHOOL_NAMES)} as names from events",
)
def _(spark, sf):
    rows = R.table(spark, sf, "events").selectExpr("event_id", R.hex_of("event_id % 256") + " as text")
    names = flags.school_names(scalars.as_int("text", 0))
    return rows.selectExpr("event_id", f"array_join({names}, '|') as names")


@query(
    "power_types",
    "select event_id, case event_id % 24 - 2 "
    + " ".join(f"when {k} then '{v}'" for k, v in _POWER_NAMES.items())
    + " else 'unknown' end as name from events",
)
def _(spark, sf):
    rows = R.table(spark, sf, "events").selectExpr("event_id", "event_id % 24 - 2 as code")
    return rows.selectExpr("event_id", f"{flags.power_type_name('code')} as name")


# Ways to write a number, by event_id % 12.
_FORMS = """case event_id % 12 when 0 then cast(event_id as string) when 1 then concat('0x', hex(event_id))
    when 2 then concat('-', event_id) when 3 then concat('0', event_id) when 4 then concat(event_id, '.5')
    when 5 then 'nil' when 6 then 'NIL' when 7 then 'True' when 8 then concat('0b', bin(event_id))
    when 9 then concat('-0X', hex(event_id)) when 10 then concat(event_id, 'e2') else '1.0d' end"""
_INT_SQL = """case event_id % 12 when 0 then event_id when 1 then event_id when 2 then -event_id
    when 8 then event_id when 9 then -event_id end"""


def _forms(spark, sf):
    return R.table(spark, sf, "events").selectExpr("event_id", f"{_FORMS} as text")


@query(
    "scalar_int",
    f"select event_id, {_INT_SQL} as value, coalesce({_INT_SQL}, 0) as value_or_zero from events",
)
def _(spark, sf):
    return _forms(spark, sf).selectExpr(
        "event_id",
        scalars.as_int("text") + " as value",
        scalars.as_int("text", 0) + " as value_or_zero",
    )


@query("scalar_bool", f"select event_id, ({_INT_SQL}) <> 0 as value from events")
def _(spark, sf):
    return _forms(spark, sf).selectExpr("event_id", scalars.as_bool("text") + " as value")


@query(
    "scalar_float",
    """select event_id, case event_id % 12 when 0 then cast(event_id as double)
        when 2 then -cast(event_id as double) when 3 then cast(event_id as double)
        when 4 then event_id + 0.5 when 10 then event_id * 100.0 end::double as value from events""",
)
def _(spark, sf):
    return _forms(spark, sf).selectExpr("event_id", scalars.as_float("text") + " as value")


# ---- payload families over line items ----

_KEY = R.LINE_KEY
_PRICE = "cast(round(l_extendedprice * 100) as bigint)"
_QTY = "cast(l_quantity as bigint)"
_DISC = "cast(round(l_discount * 100) as bigint)"
_ODD = "(l_linenumber % 2)"


def _text(x: str) -> str:
    return f"cast({x} as string)"


def family(name: str, event: str, fam: str, fields: list[str], outputs: dict[str, tuple[str, str]], prefix: str = "spell"):
    """Register a family: rendered fields, then per output column (Spark, SQL) expressions."""
    sql = f"select {_KEY} as line_no, " + ", ".join(f"{o} as {n}" for n, (_, o) in outputs.items())

    @query(name, sql + " from lineitem")
    def _(spark, sf):
        rendered = R.item_lines(R.table(spark, sf, "lineitem"), event, *fields, prefix=prefix)
        found = L.payload(L.parse_events(rendered), fam, "line_no")
        return found.selectExpr("line_no", *[f"{s} as {n}" for n, (s, _) in outputs.items()])


_NIL_DISC = f"if(l_linenumber % 3 = 0, 'nil', {_text(_DISC)})"
_NULL_DISC = f"case when l_linenumber % 3 = 0 then null else {_DISC} end"
_HIT = [
    _text(_PRICE), _text(f"-{_QTY}"), R.hex_of(f"{_QTY} % 128"), _NIL_DISC, "'0'", "'7'",
    _text(_ODD), "'nil'", "'1'",
]
_HIT_OUT = {
    "amount": ("amount", _PRICE),
    "overkill": ("overkill", f"-{_QTY}"),
    "school": ("school", f"{_QTY} % 128"),
    "schools": ("array_join(schoolNames, '|')", _names_sql(f"({_QTY} % 128)", _SCHOOL_NAMES)),
    "resisted": ("resisted", _NULL_DISC),
    "blocked": ("blocked", "0::bigint"),
    "absorbed": ("absorbed", "7::bigint"),
    "critical": ("critical", f"{_ODD} <> 0"),
    "glancing": ("glancing", "null::boolean"),
    "crushing": ("crushing", "true"),
}
_TARGET = ["concat('Creature-', l_suppkey)", "concat('\"Mob ', l_suppkey, '\"')"]
_TARGET_OUT = {
    "target_guid": ("target_guid", "'Creature-' || l_suppkey"),
    "target_name": ("target_name", "'Mob ' || l_suppkey"),
}
family("damage_short", "SPELL_DAMAGE", "damage", _HIT,
       {**_HIT_OUT, "is_off_hand": ("is_off_hand", "null::boolean")})
family(
    "damage_long", "RANGE_DAMAGE", "damage", _TARGET + _HIT + ["'0'", "'1'", "'x'", "'y'"],
    {
        **_TARGET_OUT, **_HIT_OUT, "is_off_hand": ("is_off_hand", "false"),
        "multistrike": ("multistrike", "true"), "extra": ("array_join(extra, '|')", "'x|y'"),
    },
)
family("swing_damage", "SWING_DAMAGE_LANDED", "damage", _HIT, _HIT_OUT, prefix="none")
_MEND = [_text(_PRICE), _text(_QTY), _NIL_DISC, _text(_ODD)]
_MEND_OUT = {
    "amount": ("amount", _PRICE), "overhealing": ("overhealing", _QTY),
    "absorbed": ("absorbed", _NULL_DISC), "critical": ("critical", f"{_ODD} <> 0"),
}
family("heal_short", "SPELL_HEAL", "heal", _MEND, _MEND_OUT)
family("heal_long", "SPELL_PERIODIC_HEAL", "heal", _TARGET + _MEND + ["'0x1'"],
       {**_TARGET_OUT, **_MEND_OUT, "multistrike": ("multistrike", "true")})
family(
    "miss", "DAMAGE_SHIELD_MISSED", "miss",
    ["'ABSORB'", "'nil'", _text(f"{_QTY} % 3"), _text(_DISC), _text(_PRICE)],
    {
        "miss_type": ("missType", "'ABSORB'"), "off_hand": ("isOffHand", "null::boolean"),
        "missed": ("amountMissed", f"case when {_QTY} % 3 = 0 then {_PRICE} else {_QTY} % 3 end"),
        "absorbed": ("amountAbsorbed", _DISC), "resisted": ("amountResisted", _PRICE),
    },
)
family(
    "energize", "SPELL_ENERGIZE", "energize",
    [_text("l_extendedprice"), _text("l_linenumber"), "'nil'", _text("l_quantity")],
    {
        "amount": ("amount", "l_extendedprice"), "power_type": ("power_type", "'unknown'"),
        "extra_amount": ("extra_amount", "null::double"), "max_power": ("max_power", "l_quantity"),
    },
)
family(
    "drain", "SPELL_PERIODIC_DRAIN", "drain", [_text(_PRICE), _text(f"{_QTY} % 22 - 2"), _NIL_DISC],
    {
        "amount": ("amount", _PRICE),
        "power": (
            "powerType",
            f"case {_QTY} % 22 - 2 "
            + " ".join(f"when {k} then '{v}'" for k, v in _POWER_NAMES.items())
            + " else 'unknown' end",
        ),
        "extra": ("extraAmount", _NULL_DISC),
    },
)
family("leech", "SPELL_LEECH", "leech", [_text(_PRICE), _NIL_DISC],
       {"amount": ("amount", _PRICE), "extra": ("extraAmount", _NULL_DISC)})
family("extra_attacks", "SPELL_EXTRA_ATTACKS", "extra_attacks", [_text(_QTY)],
       {"amount": ("amount", _QTY)})
family(
    "spell_block", "SPELL_SPELL_BLOCK", "spell_block",
    [_text("l_partkey"), "'\"Kick\"'", R.hex_of(f"{_QTY} % 128")],
    {
        "spell_id": ("extraSpellId", "l_partkey"), "spell_name": ("extraSpellName", "'Kick'"),
        "school": ("extraSchool", f"{_QTY} % 128"),
    },
)
_AURA_OUT = {
    "aura_type": ("auraType", "case when l_linenumber % 2 = 1 then 'BUFF' else 'DEBUFF' end"),
    "amount": ("amount", _NULL_DISC),
}
_AURA = ["if(l_linenumber % 2 = 1, '\"BUFF\"', 'DEBUFF')", _NIL_DISC]
family("aura", "SPELL_AURA_REMOVED", "aura", _AURA, _AURA_OUT)
family("aura_refresh", "SPELL_AURA_REFRESH", "aura", _AURA, _AURA_OUT)
family("aura_dose", "SPELL_AURA_REMOVED_DOSE", "aura_dose", ["'BUFF'", _NIL_DISC],
       {"aura_type": ("auraType", "'BUFF'"), "dose": ("newDose", f"coalesce({_NULL_DISC}, 0)")})
family(
    "aura_broken_spell", "SPELL_AURA_BROKEN_SPELL", "aura_broken_spell",
    [_text("l_partkey"), "'\"Frost\"'", "'16'", "'DEBUFF'"],
    {
        "spell_id": ("extraSpellId", "l_partkey"), "spell_name": ("extraSpellName", "'Frost'"),
        "school": ("extraSchool", "16::bigint"), "aura_type": ("auraType", "'DEBUFF'"),
    },
)
family(
    "absorbed", "SPELL_ABSORBED", "absorbed",
    ["concat('Player-', l_suppkey)", "'\"Ann\"'", _text("l_partkey"), "'\"Ward\"'", _text(_QTY),
     _text(_PRICE), _text(_ODD)],
    {
        "caster": ("casterGuid", "'Player-' || l_suppkey"), "caster_name": ("casterName", "'Ann'"),
        "spell_id": ("absorbSpellId", "l_partkey"), "spell_name": ("absorbSpellName", "'Ward'"),
        "amount": ("absorbedAmount", _QTY), "total": ("totalAbsorbed", _PRICE),
        "critical": ("isCritical", f"{_ODD} <> 0"),
    },
)
family("cast_failed", "SPELL_CAST_FAILED", "cast_failed", ["concat('\"No ', l_returnflag, '\"')"],
       {"failed": ("failedType", "'No ' || l_returnflag")})
family(
    "spell_prefix", "SPELL_CAST_SUCCESS", "spell", ["'trailing'"],
    {
        "spell_id": ("spellId", f"({_KEY}) % 1000"),
        "spell_name": ("spellName", f"'Spell ' || ({_KEY}) % 1000"),
        "school": ("spellSchool", f"({_KEY}) % 128"),
        "schools": (
            "array_join(spellSchoolNames, '|')", _names_sql(f"(({_KEY}) % 128)", _SCHOOL_NAMES)
        ),
    },
)
family(
    "enchant", "ENCHANT_APPLIED", "enchant", ["'\"Sharp\"'", _text("l_partkey"), "'\"Sword\"'"],
    {
        "name": ("enchantName", "'Sharp'"), "item_id": ("itemId", "l_partkey"),
        "item_name": ("itemName", "'Sword'"),
    },
    prefix="none",
)


@query(
    "environment",
    f"select {_KEY} as line_no, 'Fall' || l_linenumber as kind, {_PRICE} as amount from lineitem",
)
def _(spark, sf):
    rendered = R.item_lines(
        R.table(spark, sf, "lineitem"), "ENVIRONMENTAL_DAMAGE", "concat('Fall', l_linenumber)", *_HIT,
        prefix="none",
    )
    found = L.payload(L.parse_events(rendered), "damage", "line_no", "environmentalType")
    return found.selectExpr("line_no", "environmentalType as kind", "amount")


@query(
    "empty_payload",
    f"""select {_KEY} as line_no, 'special' as route, 'Dst ' || ({_KEY}) % 50 as dest_name,
        'ok' as status from lineitem""",
)
def _(spark, sf):
    rendered = R.item_lines(R.table(spark, sf, "lineitem"), "UNIT_DIED", "'0'", prefix="none")
    return L.parse_events(rendered).selectExpr(
        "line_no", "route", "actors.destName as dest_name", "status"
    )


@query(
    "payload_errors",
    f"""select {_KEY} as line_no, case l_linenumber % 3 when 0 then 'Insufficient DRAIN data'
        when 1 then null else 'Insufficient DRAIN data' end as error,
        case l_linenumber % 3 when 0 then {_PRICE}::varchar when 2 then {_PRICE}::varchar || '|3' end as data,
        'ok' as status from lineitem""",
)
def _(spark, sf):
    short = f"case l_linenumber % 3 when 0 then {_text(_PRICE)} when 2 then concat({_PRICE}, ',3') else concat({_PRICE}, ',3,nil') end"
    rendered = R.item_lines(R.table(spark, sf, "lineitem"), "SPELL_DRAIN", short)
    return L.parse_events(rendered).selectExpr(
        "line_no", "error", "array_join(error_cols, '|') as data", "status"
    )


# ---- standalone events ----


@query(
    "encounter",
    """select o_orderkey as line_no, case when o_orderkey % 4 <> 0 then o_custkey end as encounter_id,
        case when o_orderkey % 4 <> 0 then 'Boss ' || o_orderstatus end as boss,
        case when o_orderkey % 4 <> 0 then 16::bigint end as difficulty,
        case when o_orderkey % 4 = 0
          then 'Failed to parse ENCOUNTER data: invalid literal for int() with base 10: ''x''' end as error
        from orders""",
)
def _(spark, sf):
    rendered = R.plain_lines(
        R.table(spark, sf, "orders"), "ENCOUNTER_START", "o_orderkey",
        "if(o_orderkey % 4 = 0, 'x', cast(o_custkey as string))",
        "concat('\"Boss ', o_orderstatus, '\"')", "'16'", "'20'",
    )
    return L.parse_events(rendered).selectExpr(
        "line_no", "encounter.encounterId as encounter_id", "encounter.encounterName as boss",
        "encounter.difficultyId as difficulty", "error",
    )


@query(
    "arena_start",
    """select o_orderkey as line_no, o_custkey as instance_id, 'map' || o_orderkey % 9 as map,
        null::bigint as map_id, '2v2' as match_type, 1::bigint as team_size,
        case when o_orderkey % 2 = 0 then 'a|b' end as extra from orders""",
)
def _(spark, sf):
    rendered = R.plain_lines(
        R.table(spark, sf, "orders"), "ARENA_MATCH_START", "o_orderkey", "cast(o_custkey as string)",
        "concat('\"map', o_orderkey % 9, '\"')", "'\"2v2\"'", "'1'",
        "if(o_orderkey % 2 = 0, '\"a\",b', null)",
    )
    return L.payload(L.parse_events(rendered), "arena_start", "line_no").selectExpr(
        "line_no", "instanceId_int as instance_id", "mapId as map", "mapId_int as map_id",
        "matchType as match_type", "teamSize_int as team_size", "array_join(extraFields, '|') as extra",
    )


@query(
    "arena_end",
    """select o_orderkey as line_no, case when o_orderkey % 6 <> 0 then o_orderkey % 2 end as team,
        case when o_orderkey % 6 <> 0 then o_custkey end as duration,
        case when o_orderkey % 6 = 0 then 'malformed' else 'ok' end as status from orders""",
)
def _(spark, sf):
    rendered = R.plain_lines(
        R.table(spark, sf, "orders"), "ARENA_MATCH_END", "o_orderkey", "cast(o_orderkey % 2 as string)",
        "cast(o_custkey as string)", "if(o_orderkey % 6 = 0, '1.5', '01')", "'2'",
    )
    return L.parse_events(rendered).selectExpr(
        "line_no", "arena_end.winningTeamId as team", "arena_end.matchDuration as duration", "status"
    )


@query(
    "world_marker",
    """select o_orderkey as line_no, case when o_orderkey % 3 = 0 then true end as removed,
        case when o_orderkey % 3 = 0 then 'SKULL' end as flag,
        case when o_orderkey % 3 = 1 then o_custkey end as map_id,
        case when o_orderkey % 3 = 1 then o_totalprice end as x,
        case when o_orderkey % 3 = 1 then 0.0::double end as y,
        case when o_orderkey % 3 = 2 then 'Insufficient data for WORLD_MARKER' end as error,
        case when o_orderkey % 3 = 2 then '1|2' end as data from orders""",
)
def _(spark, sf):
    fields = """case o_orderkey % 3 when 0 then 'SKULL'
        when 1 then concat_ws(',', cast(o_custkey as string), '3', cast(o_totalprice as string), 'bad')
        else '1,2' end"""
    rendered = R.plain_lines(R.table(spark, sf, "orders"), "WORLD_MARKER_PLACED", "o_orderkey", fields)
    return L.parse_events(rendered).selectExpr(
        "line_no", "world_marker.removed as removed", "world_marker.flag as flag",
        "world_marker.mapId as map_id", "world_marker.x as x", "world_marker.y as y", "error",
        "array_join(error_cols, '|') as data",
    )


@query(
    "zone_change",
    """select n_nationkey::bigint as line_no, n_regionkey::varchar as zone_id, n_name as zone_name,
        case when n_nationkey % 2 = 0 then '0' end as zone_flag from nation""",
)
def _(spark, sf):
    rendered = R.plain_lines(
        R.table(spark, sf, "nation"), "ZONE_CHANGE", "n_nationkey", "'0'", "cast(n_regionkey as string)",
        "concat('\"', n_name, '\"')", "if(n_nationkey % 2 = 0, '0', null)",
    )
    return L.payload(L.parse_events(rendered), "zone", "line_no").selectExpr(
        "line_no", "zoneId as zone_id", "zoneName as zone_name", "zoneFlag as zone_flag"
    )


# ---- combatants ----

_PEOPLE_SQL = """from (select coalesce(c_custkey, p_partkey) as c_custkey, p_partkey, p_size
    from part left join customer on p_partkey = c_custkey)"""


def _combatants(spark, sf):
    rendered = R.combatant_lines(R.table(spark, sf, "customer"), R.table(spark, sf, "part"))
    return L.parse_combatants(L.parse_events(rendered))


@query(
    "combatant_stats",
    "select c_custkey as line_no, 'Player-' || c_custkey as guid, c_custkey % 2 as faction, "
    + ", ".join(f"(c_custkey * {i + 3}) % 1000 as {s}" for i, s in enumerate(_STAT_NAMES))
    + f", c_custkey % 300 as spec_id {_PEOPLE_SQL}",
)
def _(spark, sf):
    return _combatants(spark, sf).selectExpr("line_no", "player.*", "stats.*")


@query(
    "combatant_talents",
    f"""select c_custkey as line_no, case when c_custkey % 2 = 0 then 'nodes' else 'ids' end as kind,
        case when c_custkey % 2 = 0 then c_custkey || ':' || c_custkey + 1 || ':1|' || c_custkey + 2
          || ':' || c_custkey + 3 || ':2'
          else c_custkey || '|' || c_custkey + 1 || '|' || c_custkey + 2 end as talents,
        '0|' || c_custkey || '|' || c_custkey + 1 || '|5' as pvp {_PEOPLE_SQL}""",
)
def _(spark, sf):
    nodes = "transform(class_talents.nodes, n -> concat_ws(':', n.talent_id, n.spell_id, n.rank))"
    return _combatants(spark, sf).selectExpr(
        "line_no", "class_talents.kind as kind",
        f"coalesce(array_join({nodes}, '|'), array_join(class_talents.ids, '|')) as talents",
        "array_join(pvp_talents, '|') as pvp",
    )


@query(
    "combatant_expansion",
    f"""select c_custkey as line_no, case c_custkey % 4 when 0 then 'shadowlands' when 1 then 'artifact'
          when 2 then 'none' else 'other' end as kind,
        case when c_custkey % 4 = 0 then c_custkey % 20 end as soulbind,
        case when c_custkey % 4 = 0 then 1::bigint end as covenant,
        case when c_custkey % 4 = 0 then c_custkey || ':335:1|7:8:2' end as anima,
        case when c_custkey % 4 = 0 then '1379|' || c_custkey end as traits,
        case when c_custkey % 4 = 0 then '233:200|' || c_custkey || ':213' end as conduits,
        case when c_custkey % 4 = 1 then '10:1|' || c_custkey || ':2' end as artifact,
        case when c_custkey % 4 = 3 then '[1,2,' || c_custkey || ']' end as raw {_PEOPLE_SQL}""",
)
def _(spark, sf):
    pairs = lambda a, *fs: f"array_join(transform({a}, p -> concat_ws(':', {', '.join('p.' + f for f in fs)})), '|')"
    return _combatants(spark, sf).selectExpr("line_no", "expansion_powers.*").selectExpr(
        "line_no", "kind", "soulbind_id as soulbind", "covenant_id as covenant",
        pairs("anima_powers", "spell_id", "maw_power_id", "count") + " as anima",
        "array_join(soulbind_traits, '|') as traits",
        pairs("conduits", "id", "item_level") + " as conduits",
        pairs("artifact_traits", "trait_id", "rank") + " as artifact",
        "raw",
    )


@query(
    "combatant_equipment",
    f"""select c_custkey as line_no, 0 as slot, p_partkey as item_id, p_size::bigint as item_level,
        '' as enchants, '1479|' || p_size as bonus, '' as gems {_PEOPLE_SQL}
        union all select c_custkey, 1, c_custkey, 90::bigint, '0|0|4223', '6707', '5:6|7' {_PEOPLE_SQL}""",
)
def _(spark, sf):
    gear = _combatants(spark, sf).selectExpr("line_no", "posexplode(equipment) as (slot, item)")
    return gear.selectExpr(
        "line_no", "slot", "item.item_id as item_id", "item.item_level as item_level",
        "array_join(item.enchants, '|') as enchants", "array_join(item.bonus_list, '|') as bonus",
        "array_join(transform(item.gems, g -> concat_ws(':', g.id, g.item_level)), '|') as gems",
    )


@query(
    "combatant_auras_pvp",
    f"""select c_custkey as line_no, 'Player-' || c_custkey || ':295365|Player-' || c_custkey || ':'
        || c_custkey as auras, c_custkey % 50 as honor_level, 1::bigint as season,
        c_custkey % 3000 as rating, c_custkey % 6 as tier {_PEOPLE_SQL}""",
)
def _(spark, sf):
    auras = "transform(interesting_auras, a -> concat_ws(':', a.caster_guid, a.spell_id_int))"
    return _combatants(spark, sf).selectExpr(
        "line_no", f"array_join({auras}, '|') as auras", "pvp_stats.*"
    )


# ---- quality ----

_STATUS = """case when user_id % 10 = 7 and event_id % 29 = 0 then 'malformed'
    when user_id % 10 = 8 and event_id % 97 = 0 then 'malformed'
    when user_id % 10 = 9 and event_id % 61 = 0 then 'malformed'
    when user_id % 10 = 6 and event_id % 53 = 0 then 'fatal'
    when event_id % 16 = 15 and event_id % 3 = 0 then 'dropped' else 'ok' end"""
_ERROR = """case when user_id % 10 = 7 then 'Invalid format for SWING_DAMAGE: insufficient columns'
    when user_id % 10 = 8 then 'invalid literal for int() with base 10: ''x'''
    when user_id % 10 = 9 then 'incomplete line: stats' when user_id % 10 = 6 then 'list index out of range' end"""
# One row per event with its status, then the verdict of its file.
_JUDGED = f"""judged as (select *, event_id + 1 as line_no, '2024_' || user_id || '.txt' as file, {_STATUS} as status
      from events),
    numbered as (select *, row_number() over (partition by file order by line_no) as nth
      from judged where status in ('malformed', 'fatal')),
    verdicts as (select file, min(line_no) as reject_line from numbered
      where status = 'fatal' or user_id % 10 = 9 or nth = 2 group by file)"""
_STATUS_SQL = f"""with {_JUDGED} select j.file, v.file is null as ok,
    case any_value(j.user_id % 10) filter (v.file is not null) when 6 then 'fatal line'
      when 9 then 'malformed combatant' else case when v.file is not null then 'too many malformed lines' end
      end as reason,
    v.reject_line, case when v.file is not null then any_value({_ERROR}) end as error,
    count(*) as n_lines, count(*) filter (status = 'ok') as n_ok,
    count(*) filter (status = 'dropped') as n_dropped, count(*) filter (status = 'malformed') as n_malformed,
    count(*) filter (status = 'fatal') as n_fatal
    from judged j left join verdicts v on j.file = v.file group by j.file, v.file, v.reject_line"""


@query("line_status", f"select event_id + 1 as line_no, {_STATUS} as status from events")
def _(spark, sf):
    return _parsed(spark, sf, True).select("line_no", "status")


@query(
    "dropped_summon",
    "select event_id + 1 as line_no, 'SPELL_SUMMON' as warning from events "
    f"where {_STATUS} = 'dropped'",
)
def _(spark, sf):
    dropped = _parsed(spark, sf, True).where("status = 'dropped'")
    return dropped.selectExpr("line_no", "warning_label as warning")


@query("file_status", _STATUS_SQL)
def _(spark, sf):
    return L.file_status(_parsed(spark, sf, True))


def _judged(spark, sf, *columns: str):
    """Parsed columns, kept once, and the verdicts on their files."""
    base = ["file", "line_no", "event", "status", "status_error"]
    parsed = settle(_parsed(spark, sf, True).select(*base, *columns))
    return parsed, L.file_status(parsed)


@query(
    "quarantined_events",
    f"""with {_JUDGED} select file, line_no, {_EVENT} as event, epoch_us(ts) as micros from judged
        where status = 'ok' and file not in (select file from verdicts)""",
)
def _(spark, sf):
    parsed, status = _judged(spark, sf, "event_time")
    good = L.apply_quarantine(parsed, status)
    return good.selectExpr("file", "line_no", "event", "unix_micros(event_time) as micros")


_SAMPLE = f"""case when status = 'dropped' then
      '[''SPELL_SUMMON'', ''Player-' || event_id || ''', ''"Src ' || event_id % 100 || '"'', '''
      || {_hex_sql(_SRC_FLAGS)} || ''', ''' || {_hex_sql('(event_id % 16)')} || ''', ''Creature-'
      || event_id % 977 || ''']'
    else '[''' || event_id % 3 || ''']' end"""
_WARNED = f"""with {_JUDGED}, warned as (select j.file, line_no,
      case when status = 'dropped' then 'SPELL_SUMMON' else 'DRAIN' end as event,
      case when status = 'dropped' then 'source/dest (8 cols) + spellId, spellName, spellSchool'
        else '>= 3 cols' end as reason, {_SAMPLE} as cols
      from judged j left join verdicts v on j.file = v.file
      where (status = 'dropped' or (status = 'ok' and event_id % 16 = 5 and event_id % 5 = 0))
        and (v.reject_line is null or line_no <= v.reject_line)),
    ids as (select *, left(md5(event || '|' || reason || '|' || file || '|' || cols), 8) as warning_id from warned)"""


def _warnings(spark, sf):
    parsed, status = _judged(
        spark, sf, "warning_label", "warning_reason", "warning_message", "warning_cols", "raw"
    )
    return L.warning_lines(L.seen_lines(parsed, status))


@query(
    "parse_warnings",
    f"""{_WARNED} select file, warning_id, event, reason, cols, count(*) as n, min(line_no) as first_line,
        max(line_no) as last_line from ids group by all""",
)
def _(spark, sf):
    return L.parse_warnings(_warnings(spark, sf))


@query(
    "warning_occurrence",
    f"""{_WARNED} select file, line_no, warning_id,
        row_number() over (partition by file, warning_id order by line_no) as occurrence from ids""",
)
def _(spark, sf):
    return L.warning_occurrence(_warnings(spark, sf)).select(
        "file", "line_no", "warning_id", "occurrence"
    )


@query(
    "error_rollup",
    f"""select reason || ': ' || error as message, count(*) as n from ({_STATUS_SQL})
        where not ok group by 1""",
)
def _(spark, sf):
    return L.error_rollup(L.file_status(_parsed(spark, sf, True)))


@query(
    "run_summary",
    f"""select count(*) filter (ok) as converted, count(*) filter (not ok) as skipped,
        sum(n_lines)::bigint as n_lines, sum(n_ok)::bigint as n_ok, sum(n_dropped)::bigint as n_dropped,
        sum(n_malformed)::bigint as n_malformed, sum(n_fatal)::bigint as n_fatal from ({_STATUS_SQL})""",
)
def _(spark, sf):
    return L.run_summary(L.file_status(_parsed(spark, sf, True)))


@query(
    "reconcile",
    f"""with {_JUDGED}, l as (select distinct epoch_us(ts) as t from events),
        r as (select distinct epoch_us(ts) as t from judged
          where status = 'ok' and file not in (select file from verdicts))
        select (select count(*) from (from r except from l)) as missing_left,
          (select count(*) from (from l except from r)) as missing_right,
          (select count(*) from (from l except from r)) = 0 as equal""",
)
def _(spark, sf):
    parsed, status = _judged(spark, sf, "event_time")
    source = L.parse_header(_events(spark, sf))
    return L.reconcile_summary(source, L.apply_quarantine(parsed, status))


# ---- ingest, files, pages ----

_HEX_KEY = "lpad(lower(hex({})), 32, '0')"
_LISTED = _HEX_KEY.format("o_custkey")
_TAKEN = _HEX_KEY.format("c_custkey")


def _listing(spark, sf):
    """One listing line per order."""
    text = f"""concat('<Contents><Key>', {_LISTED}, '</Key><Size>', o_orderkey, '</Size></Contents>')"""
    return L.list_keys(R.table(spark, sf, "orders").selectExpr(f"{text} as value"))


def _manifest(spark, sf):
    """Manifest of the customers with even keys, one JSON array per customer."""
    arrays = f"""concat('["', if(c_custkey % 2 = 0, {_TAKEN}, {_HEX_KEY.format('c_custkey + 1')}), '"]')"""
    return keys_of_json(R.table(spark, sf, "customer").selectExpr(f"{arrays} as value"))


_MANIFEST_SQL = f"select lpad(lower(hex(c_custkey + c_custkey % 2)), 32, '0') as key from customer"


@query("list_keys", f"select distinct {_LISTED} as key from orders")
def _(spark, sf):
    return _listing(spark, sf)


@query(
    "new_keys",
    f"""select key, 'https://logs.example/x/' || key as url
        from (select {_LISTED} as key from orders except {_MANIFEST_SQL})""",
)
def _(spark, sf):
    return L.new_keys(_listing(spark, sf), _manifest(spark, sf), "https://logs.example/x/")


@query("manifest_update", f"select {_LISTED} as key from orders union {_MANIFEST_SQL}")
def _(spark, sf):
    return union_keys(_manifest(spark, sf), _listing(spark, sf)).orderBy("key")


@query("smallest_files", "select doc_id, n_chars from documents order by n_chars, doc_id limit 20")
def _(spark, sf):
    return smallest(R.table(spark, sf, "documents").select("doc_id", "n_chars"), 20, "n_chars", "doc_id")


# The heading by cutting at the tags, not by the engine's pattern.
_HEADING_SQL = """split_part(substr(html, strpos(html, '<h1>') + 4), '</h1>', 1)"""


@query(
    "page_attributes",
    f"""select page_id, case when contains(html, '<h1>') then replace(replace(replace(replace(
          {_HEADING_SQL}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') end as name,
        null::double as strength, null::double as agility, null::double as stamina from pages""",
)
def _(spark, sf):
    return L.extract_page_attributes(R.table(spark, sf, "pages"))


@query(
    "page_stats",
    """select o_orderkey as page_id, 'Order & <' || o_orderkey || '> ü' as name, o_totalprice as strength,
        -(o_custkey::double) as agility,
        case when o_orderkey % 2 = 0 then (o_orderkey % 10)::double end as stamina from orders""",
)
def _(spark, sf):
    html = """concat('<html><h1 id="t">Order &amp &lt;<b>', o_orderkey, '</b>&#62; &uuml;</h1><p><span class="x strength">',
        o_totalprice, '</span><span class=agility> &#45;', o_custkey, '&nbsp;</span>',
        if(o_orderkey % 2 = 0, concat('<span class="stamina">', o_orderkey % 10, '</span>'),
           '<span class="stamina">n/a</span>'), '</p></html>')"""
    pages = R.table(spark, sf, "orders").selectExpr("o_orderkey as page_id", f"{html} as html")
    return L.extract_page_attributes(pages)


@query(
    "key_names",
    f"""select o_orderkey, {_LISTED} as key, strftime(o_orderdate::timestamp, '%Y%m%d') || '_000000_' || {_LISTED}
        || '.txt' as file from orders""",
)
def _(spark, sf):
    urls = R.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "cast(o_orderdate as timestamp) as taken", f"concat('https://logs.example/x/', {_LISTED}) as url"
    )
    keyed = urls.selectExpr("o_orderkey", "taken", f"{key_of_url('url')} as key")
    return keyed.selectExpr("o_orderkey", "key", f"{log_file_name('taken', 'key')} as file")


@query(
    "number_lines",
    r"""select doc_id, i as line_no, lines[i] as raw from (
          select doc_id, lines, unnest(range(1, len(lines) + 1)) as i
          from (select doc_id, string_split_regex(text, '\r\n|\r|\n') as lines from documents))
        where lines[i] <> ''""",
)
def _(spark, sf):
    return L.lines_of_texts(R.table(spark, sf, "documents").selectExpr("doc_id", "text as value"))


# ---- nested literals ----

_DEPTH = "(p_partkey % 15 + 1)"


@query(
    "nested_depth",
    f"""select p_partkey, 3 as n, case when p_partkey % 2 = 0 then repeat('[', {_DEPTH}) || p_partkey || ',x' || repeat(']', {_DEPTH})
          else repeat('(', {_DEPTH}) || p_partkey || ',x' || repeat(')', {_DEPTH}) end as middle,
        case when p_partkey % 2 = 0 then repeat('[', {_DEPTH}) || p_partkey || repeat(']', {_DEPTH})
          else p_partkey::varchar end as json from part""",
)
def _(spark, sf):
    nest = lambda inner: (
        f"if(p_partkey % 2 = 0, concat(repeat('[', {_DEPTH}), {inner}, repeat(']', {_DEPTH})), "
        f"concat(repeat('(', {_DEPTH}), {inner}, repeat(')', {_DEPTH})))"
    )
    texts = R.spread(R.table(spark, sf, "part").select("p_partkey")).selectExpr(
        "p_partkey", f"concat('a,', {nest('p_partkey, ' + repr(',x'))}, ',b') as line", f"{nest('p_partkey')} as token"
    )
    read = texts.selectExpr("p_partkey", f"{split_nested('line')} as parts", f"{literal_json(tidy_literal('token'))} as json")
    return read.selectExpr("p_partkey", "size(parts) as n", "get(parts, 1) as middle", "json")


@query(
    "combatant_literals",
    """select p_partkey, case p_partkey % 6 when 0 then '[' || p_partkey || '.5,2]' when 1 then '["' || p_partkey || '"]'
        when 2 then '[null,' || p_partkey || ']' when 3 then p_partkey::varchar when 4 then '[0,' || p_partkey || ']'
        else '[' || p_partkey || ',2]' end as json from part""",
)
def _(spark, sf):
    token = """case p_partkey % 6 when 0 then concat('[', p_partkey, '.5, 2]') when 1 then concat("['", p_partkey, "']")
        when 2 then concat('[None, ', p_partkey, ']') when 3 then concat('((((', p_partkey, '))))')
        when 4 then concat('[00,', p_partkey, ']') else concat('((', p_partkey, ', 2))') end"""
    tokens = R.spread(R.table(spark, sf, "part").select("p_partkey")).selectExpr("p_partkey", f"{token} as token")
    return tokens.selectExpr("p_partkey", f"{literal_json(tidy_literal('token'))} as json")


# ---- skipped lines, own routes, export ----


@query(
    "skipped_lines",
    f"""with {_JUDGED} select j.file, line_no, {_ERROR} as error,
          row_number() over (partition by j.file order by line_no) as occurrence
        from judged j left join verdicts v on j.file = v.file
        where status = 'malformed' and (v.file is null or line_no < reject_line)""",
)
def _(spark, sf):
    parsed, status = _judged(spark, sf, "raw")
    return L.skipped_lines(parsed, status).select("file", "line_no", "error", "occurrence")


@query(
    "own_prefix",
    f"""select replace(event, 'SPELL_', 'PET_') as event,
          case when event like 'SPELL\\_%' escape '\\' and event not like 'SPELL\\_PERIODIC%' escape '\\' and route = 'table'
            then 'table' when event like 'SPELL\\_%' escape '\\' then 'unparsed' else route end as route, count(*) as n
        from (select {_EVENT} as event, {_by_slot(_ROUTES)} as route from events) group by 1, 2""",
)
def _(spark, sf):
    named = L.parse_header(_events(spark, sf)).withColumn("event", F.expr("replace(event, 'SPELL_', 'PET_')"))
    routed = L.route_events(named, L.RouteRegistry().add_prefix("PET", "spell"))
    return routed.groupBy("event", "route").agg(F.count(F.lit(1)).alias("n"))


def _export_parsed(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed events, dealt over the cores: parsing and writing them out takes far longer than reading the table."""
    return L.parse_events(R.event_lines(R.spread(R.table(spark, sf, "events"))))


@query(
    "event_export",
    f"select event_id + 1 as line_no, {_EVENT} as event, epoch_us(ts) as micros from events",
)
def _(spark, sf):
    parsed = _export_parsed(spark, sf)
    exported = parsed.selectExpr("line_no", f"from_json({L.event_json(parsed)}, 'timestamp double, event string') as e")
    return exported.selectExpr("line_no", "e.event as event", "cast(round(e.timestamp * 1e6) as bigint) as micros")


@query("exported_timestamps", "select distinct epoch_us(ts) as micros from events")
def _(spark, sf):
    parsed = _export_parsed(spark, sf)
    return L.timestamps(parsed.selectExpr(f"from_json({L.event_json(parsed)}, 'timestamp double').timestamp as timestamp"))


_SLOT_VALUES = [
    f"{_AMOUNT} || '|-1|' || event_id % 128 || '|true|false'", f"{_AMOUNT}::varchar", "'BUFF'", "'DEBUFF|' || event_id % 10", "'unknown'",
    f"{_AMOUNT} || '|true|true'", f"'Player-9|Caster|17|Shield|' || {_AMOUNT} || '|' || {_AMOUNT}", "'Not ready'", "'Spell ' || event_id % 1000", "'14'",
    f"{_AMOUNT} || '|-1|1|true|false'", "'Sharp|' || event_id % 5000 || '|Sword'", "event_id % 900 || '|' || event_id % 8", "event_id % 3000 || '|Zone|0'",
    "'1552|' || event_id % 40 || '|2v2|1'", "'Spell ' || event_id % 1000",
]


@query(
    "export_roundtrip",
    f"""select event_id + 1 as line_no, {_EVENT} as event, epoch_us(ts) as micros,
          case event_id % 16 {' '.join(f'when {i} then {v}' for i, v in enumerate(_SLOT_VALUES))} end as seen,
          case when event_id % 16 in (12, 13, 14) then null else 'Player-' || event_id end as source
        from events""",
)
def _(spark, sf):
    parsed = _export_parsed(spark, sf)
    back = L.typed_events(settle(parsed.selectExpr("line_no", f"{L.event_json(parsed)} as value")))
    damage = "concat_ws('|', damage.amount, damage.overkill, damage.school, damage.critical, array_contains(keys, 'glancing'))"
    arena = "concat_ws('|', arena_start.instanceId_int, arena_start.mapId_int, arena_start.matchType, arena_start.teamSize_int)"
    seen = f"""case when damage is not null then {damage} when heal is not null then string(heal.amount)
        when aura is not null then aura.auraType when aura_dose is not null then concat_ws('|', aura_dose.auraType, aura_dose.newDose)
        when energize is not null then energize.power_type
        when drain is not null then concat_ws('|', drain.amount, drain.extraAmount is null, array_contains(keys, 'extraAmount'))
        when absorbed is not null then concat_ws('|', absorbed.casterGuid, absorbed.casterName, absorbed.absorbSpellId,
          absorbed.absorbSpellName, absorbed.absorbedAmount, absorbed.totalAbsorbed)
        when cast_failed is not null then cast_failed.failedType
        when unparsed_params is not null then string(size(unparsed_params))
        when enchant is not null then concat_ws('|', enchant.enchantName, enchant.itemId, enchant.itemName)
        when world_marker is not null then concat_ws('|', world_marker.mapId, world_marker.markerId)
        when zone is not null then concat_ws('|', zone.zoneId, zone.zoneName, zone.zoneFlag)
        when arena_start is not null then {arena} else spell.spellName end"""
    return back.selectExpr(
        "line_no", "event", "cast(round(timestamp * 1e6) as bigint) as micros", f"{seen} as seen",
        "coalesce(actors.sourceGUID, get(unparsed_params, 0)) as source",
    )


@query(
    "literal_grammar",
    """select p_partkey, case p_partkey % 9 when 0 then p_partkey::varchar when 1 then '[' || p_partkey || ']' when 2 then '-' || p_partkey
        when 3 then '"pA' || p_partkey || '"' when 4 then '"a' || p_partkey || '"' when 5 then '[1000,15,' || p_partkey || ']'
        when 6 then '"' || chr(233) || p_partkey || '"' when 8 then '[-' || p_partkey || ',' || p_partkey || ']' end as json from part""",
)
def _(spark, sf):
    token = r"""case p_partkey % 9 when 0 then concat('0x', hex(p_partkey)) when 1 then concat('[0b', bin(p_partkey), ']')
        when 2 then concat('- ', p_partkey) when 3 then concat("'p\\x41", p_partkey, "'") when 4 then concat("'a' '", p_partkey, "'")
        when 5 then concat('[1_000, 0o17, ', p_partkey, ']') when 6 then concat("'\\u00e9", p_partkey, "'") when 7 then '0x'
        else concat('[-0x', hex(p_partkey), ', + ', p_partkey, ']') end"""
    tokens = R.spread(R.table(spark, sf, "part").select("p_partkey")).selectExpr("p_partkey", f"{token} as token")
    return tokens.selectExpr("p_partkey", f"{literal_json(tidy_literal('token'))} as json")


@query(
    "reconcile_digest",
    """select epoch_us(ts) as micros, 'left' as only_in from events group by ts having count_if(event_id % 500 <> 3) = 0
        union all select epoch_us(ts) + 86400000000 * 4000 as micros, 'right' as only_in from events where event_id % 700 = 5 group by ts""",
)
def _(spark, sf):
    events = R.table(spark, sf, "events")
    right = events.where("event_id % 500 <> 3").select("ts").unionAll(events.where("event_id % 700 = 5").selectExpr("ts + interval 4000 days as ts"))
    return L.reconcile_by_digest(events, right, "ts")


@query(
    "differing_days",
    """select user_id, floor(epoch_us(ts) / 86400000000)::bigint as day, count(*) as n_left, count_if(event_id % 500 <> 3)::bigint as n_right
        from events group by 1, 2 having count_if(event_id % 500 = 3) > 0""",
)
def _(spark, sf):
    events = R.table(spark, sf, "events")
    return L.differing_days(events, events.where("event_id % 500 <> 3"), "ts", ["user_id"])


@query(
    "own_layout",
    """select l_orderkey * 8 + l_linenumber as line_no, l_suppkey as boss, 'wave ' || l_linenumber as label, l_quantity * 2 as power
        from lineitem""",
)
def _(spark, sf):
    double = lambda x: x.cast("double") * 2
    fields = [Field("boss", 0, "int"), Field("label", 1, "text"), Field("power", 2, double)]
    registry = L.RouteRegistry().add("WAVE_START", "none", "wave", fields)
    items = R.table(spark, sf, "lineitem")
    text = ["cast(l_suppkey as string)", "concat('wave ', l_linenumber)", "cast(l_quantity as string)"]
    parsed = L.parse_events(R.item_lines(items, "WAVE_START", *text, prefix="none"), registry=registry)
    return L.payload(parsed, "wave", "line_no")


@query(
    "year_guess_now",
    """select o_orderkey, year(case when make_date(2023, month(o_orderdate), day(o_orderdate)) > date '2023-01-15' + 180
          then make_date(2022, month(o_orderdate), day(o_orderdate)) else make_date(2023, month(o_orderdate), day(o_orderdate)) end)::int as year
        from orders where not (month(o_orderdate) = 2 and day(o_orderdate) = 29)""",
)
def _(spark, sf):
    orders = R.table(spark, sf, "orders").where("not (month(o_orderdate) = 2 and day(o_orderdate) = 29)")
    lines = orders.selectExpr(
        "'plain.txt' as file", "o_orderkey as line_no", "o_orderkey",
        "concat(month(o_orderdate), '/', day(o_orderdate), ' 05:00:00.0  ZONE_CHANGE,0,1,x,0') as raw",
    )
    headed = L.parse_header(lines, now=datetime(2023, 1, 15))
    return headed.selectExpr("o_orderkey", "year(event_time) as year")
