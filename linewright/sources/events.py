"""Converted events: read them back, write them out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewright.operators.payloads import parse_events
from linewright.operators.routes import COMBATANT, RouteRegistry, route_events

EXPORT_HEAD = "timestamp double, event string, lh string"
# Families whose null fields stay in the export.
_KEEP_NULLS = ("drain", "leech", "extra_attacks", "spell_block")
_PLAIN = (
    "actors",
    "spell",
    "enchant",
    "damage",
    "heal",
    "energize",
    "aura",
    "aura_dose",
    "aura_broken_spell",
    "absorbed",
    "cast_failed",
    "encounter",
    "arena_end",
    "world_marker",
    "zone",
)
# Names of the PvP stats in the export.
_STANDING = {
    "honor_level": "Honor Level", "season": "Season", "rating": "Rating", "tier": "Tier"
}


def read_events(
    spark: SparkSession, path: str, *, schema: str = EXPORT_HEAD, array_files: bool = False
) -> DataFrame:
    """Exported events as NDJSON, or files that hold one JSON array each."""
    return spark.read.schema(schema).option("multiLine", array_files).json(path)


#: Payload members that are spelled otherwise in a struct than in the export, by family.
_READ_AS = {"arena_start": {f"{n}_int": f"try_cast(arena_start.{n} as bigint)" for n in ("instanceId", "mapId", "teamSize")}}
#: Families by what stands behind the actors.
_BY_PREFIX = ("actors", "spell", "enchant")


def typed_events(exported: DataFrame, text: str = "value", registry: RouteRegistry | None = None) -> DataFrame:
    """The inverse of ``event_json``: each JSON object back to ``timestamp, event, lh``, one
    nullable struct per family and ``keys``, the names of its members.

    An absent member and a null one are both null in a struct; ``keys`` tells them apart. A
    family whose members are all absent is null. A combatant's parts are JSON text by name
    (``combatant``), as their shapes differ from log to log. Other columns stay.
    """
    spark = exported.sparkSession
    template = parse_events(spark.createDataFrame([], "file string, line_no bigint, raw string"), registry=registry)
    texts = ", ".join(f"{n} string" for n in ("environmentalType", "error", "lh"))
    head = f"timestamp double, event string, {texts}, raw_cols array<string>, data array<string>, unparsed_params array<string>"
    out, shared = [], []
    for f in template.schema.fields:
        if not isinstance(f.dataType, T.StructType) or f.name == "combatant":
            continue
        made = _READ_AS.get(f.name, {})
        names = [x.name for x in f.dataType.fields if x.name not in made and (f.name, x.name) != ("damage", "extra")]
        ddl = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in f.dataType.fields if x.name in names)
        listed = ", ".join(f"'{n}'" for n in names)
        if f.name in _BY_PREFIX:
            # Most events hold one, so they are read with the head and the text is not parsed again for each.
            shared.append(ddl)
            mine, parts = "true", f"named_struct({', '.join(f"'{n}', _head.`{n}`" for n in names)})"
        else:
            mine, parts = f"family = '{f.name}'", f"from_json({text}, '{ddl}')"
        read = f"if({mine} and arrays_overlap(keys, array({listed})), {parts}, null)"
        out.append((f.name, read, made))
    head = ", ".join([head, *shared])
    plain = exported.select("*", F.from_json(text, head).alias("_head"), F.json_object_keys(text).alias("keys"))
    routed = route_events(plain.select("*", F.col("_head.event").alias("event")), registry or RouteRegistry())
    routed = routed.selectExpr("*", *[f"{read} as {name}" for name, read, _ in out])
    for name, _, made in out:
        filled = F.col(name)
        for member, rule in made.items():
            filled = filled.withField(member, F.expr(rule))
        routed = routed.withColumn(name, filled) if made else routed
    combatant = F.when(F.col("event") == COMBATANT, F.from_json(text, "map<string, string>"))
    kept = [c for c in exported.columns]
    return routed.select(
        *kept, "_head.timestamp", "event", "_head.lh", "keys", *[name for name, *_ in out], combatant.alias("combatant"),
        "_head.environmentalType", "_head.error", "_head.raw_cols", F.col("_head.data").alias("error_cols"), "_head.unparsed_params",
    )


def timestamps(exported: DataFrame) -> DataFrame:
    """Distinct instants of exported events, in whole microseconds."""
    return exported.select(
        F.round(F.col("timestamp") * 1e6).cast("bigint").alias("micros")
    ).distinct()


def _members(json: str) -> str:
    """Members of a JSON object without its braces, null for no members.

    A lambda, so that an object is written once and not again for its length and each test.
    """
    return f"get(transform(array({json}), j -> if(j = '{{}}', null, substring(j, 2, length(j) - 2))), 0)"


def _object(expr: str, nulls: bool = False) -> str:
    options = ", map('ignoreNullFields', 'false')" if nulls else ""
    return _members(f"to_json({expr}{options})")


def _int_or_text(struct: str, name: str) -> str:
    number, text = f"{struct}.{name}_int", f"{struct}.{name}"
    return (
        f"if({struct} is null, null, if({number} is not null, "
        f"{_object(f'''named_struct('{name}', {number})''')}, "
        f"{_object(f'''named_struct('{name}', {text})''')}))"
    )


def _combatant() -> list[str]:
    c = "combatant"
    standing = ", ".join(f"'{label}', {c}.pvp_stats.{name}" for name, label in _STANDING.items())
    powers = f"{c}.expansion_powers"
    soul = ", ".join(
        f"'{n}', {powers}.{n}"
        for n in ("soulbind_id", "covenant_id", "anima_powers", "soulbind_traits", "conduits")
    )
    spell = (
        "if(a.spell_id_int is not null, cast(a.spell_id_int as string), "
        "regexp_extract(to_json(named_struct('s', a.spell_id)), '^.....(.*).$', 1))"
    )
    auras = (
        f"array_join(transform({c}.interesting_auras, a -> concat('{{', "
        f"{_object('''named_struct('caster_guid', a.caster_guid)''')}, "
        f"',\"spell_id\":', {spell}, '}}')), ',')"
    )
    powers_json = (
        f"case {powers}.kind when 'none' then 'null' "
        f"when 'shadowlands' then to_json(named_struct({soul})) "
        f"when 'artifact' then to_json(named_struct('artifact_traits', {powers}.artifact_traits)) "
        f"else concat('{{\"data\":', {powers}.raw, '}}') end"
    )
    nulls = "map('ignoreNullFields', 'false')"
    return [
        _object(f"named_struct('player', {c}.player, 'stats', {c}.stats)"),
        f"concat('\"class_talents\":', if({c}.class_talents.kind = 'nodes', "
        f"to_json({c}.class_talents.nodes), to_json({c}.class_talents.ids)))",
        f"concat('\"pvp_talents\":', to_json({c}.pvp_talents))",
        f"concat('\"expansion_powers\":', {powers_json})",
        f"concat('\"equipment\":', to_json({c}.equipment, {nulls}))",
        f"concat('\"interesting_auras\":[', {auras}, ']')",
        f"concat('\"pvp_stats\":', to_json(named_struct({standing}), {nulls}))",
    ]


def event_json(events: DataFrame) -> str:
    """Expression: one JSON object per event with the keys of its payload side by side.

    Absent values have no key, except where a family always writes its keys.
    """
    arena = [_int_or_text("arena_start", n) for n in ("instanceId", "mapId")]
    rest = "arena_start is null, null"
    arena += [
        f"if({rest}, {_object('''named_struct('matchType', arena_start.matchType)''')})",
        _int_or_text("arena_start", "teamSize"),
        f"if({rest}, {_object('''named_struct('extraFields', arena_start.extraFields)''')})",
    ]
    miss = ", ".join(
        f"'{n}', miss.{n}" for n in ("missType", "isOffHand", "amountAbsorbed", "amountResisted")
    )
    own = [
        f.name
        for f in events.schema.fields
        if isinstance(f.dataType, T.StructType)
        and f.name not in (*_PLAIN, *_KEEP_NULLS, "miss", "arena_start", "combatant")
    ]

    parts = [
        _object("named_struct('timestamp', timestamp, 'event', event)"),
        *[
            f"if({n} is null, null, {_object(_without_extra(events, n) if n == "damage" else n)})"
            for n in (*_PLAIN, *own)
        ],
        _object("named_struct('environmentalType', environmentalType)"),
        *[f"if({n} is null, null, {_object(n, nulls=True)})" for n in _KEEP_NULLS],
        f"if(miss is null, null, {_object(f'named_struct({miss})')})",
        "if(miss is null, null, "
        + _object("named_struct('amountMissed', miss.amountMissed)", nulls=True) + ")",
        *arena,
        *[f"if(event = '{COMBATANT}', {p}, null)" for p in _combatant()],
        _object(
            "named_struct('error', error, 'raw_cols', raw_cols, 'data', error_cols, "
            "'unparsed_params', unparsed_params)"
        ),
    ]
    if "lh" in events.columns:
        parts.append(_object("named_struct('lh', lh)"))
    return f"concat('{{', concat_ws(',', {', '.join(parts)}), '}}')"


def _without_extra(events: DataFrame, family: str) -> str:
    names = [f.name for f in events.schema[family].dataType.fields if f.name != "extra"]
    return "named_struct(" + ", ".join(f"'{n}', {family}.{n}" for n in names) + ")"


def _replacing(events: DataFrame):
    """Writer that replaces the folders of the logs in ``events`` and no others."""
    return events.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file")


def write_events(events: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Write accepted events, one folder per log file, in line order inside a part.

    Only the folders of logs that are written are replaced; what other runs published, and
    older output of logs that are rejected now, stays.

    Input splits follow the files, so a task meets few files and no shuffle is needed. A
    large file gives several parts. Spark's commit shows the result only when complete.
    """
    ordered = events.sortWithinPartitions("file", "line_no")
    if fmt == "json":
        stem = "regexp_replace(file, r'\\.[^.]*$', '')"
        out = ordered.selectExpr(f"{stem} as file", f"{event_json(events)} as value")
        _replacing(out).text(path)
    elif fmt == "parquet":
        _replacing(ordered).parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")
