"""Event name to payload layout, as a small table joined to the lines."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewright.operators.specs import Field

COMBATANT = "COMBATANT_INFO"

# Event names and the families they lead to.
STANDALONE = {
    "ENCOUNTER_START": "encounter",
    "ENCOUNTER_END": "encounter",
    "ARENA_MATCH_START": "arena_start",
    "ARENA_MATCH_END": "arena_end",
    "WORLD_MARKER_PLACED": "world_marker",
    "WORLD_MARKER_REMOVED": "world_marker",
    "ZONE_CHANGE": "zone",
}
SPECIAL = {
    "DAMAGE_SHIELD": ("spell", "damage"),
    "DAMAGE_SPLIT": ("spell", "damage"),
    "DAMAGE_SHIELD_MISSED": ("spell", "miss"),
    "ENCHANT_APPLIED": ("enchant", "none"),
    "ENCHANT_REMOVED": ("enchant", "none"),
    "PARTY_KILL": ("none", "none"),
    "UNIT_DIED": ("none", "none"),
    "UNIT_DESTROYED": ("none", "none"),
}
PREFIXES = {
    "SWING": "none",
    "SPELL_BUILDING": "spell",
    "SPELL_PERIODIC": "spell",
    "SPELL": "spell",
    "RANGE": "spell",
    "ENVIRONMENTAL": "environment",
}
SUFFIXES = {
    "_AURA_APPLIED": "aura",
    "_AURA_REMOVED": "aura",
    "_AURA_BROKEN": "aura",
    "_AURA_REFRESH": "aura_refresh",
    "_AURA_APPLIED_DOSE": "aura_dose",
    "_AURA_REMOVED_DOSE": "aura_dose",
    "_AURA_BROKEN_SPELL": "aura_broken_spell",
    "_CAST_START": "none",
    "_CAST_SUCCESS": "none",
    "_CAST_FAILED": "cast_failed",
    "_INSTAKILL": "none",
    "_CREATE": "none",
    "_SUMMON": "none",
    "_RESURRECT": "none",
    "_ABSORBED": "absorbed",
    "_DAMAGE": "damage",
    "_DAMAGE_LANDED": "damage",
    "_HEAL": "heal",
    "_MISS": "miss",
    "_ENERGIZE": "energize",
    "_DRAIN": "drain",
    "_LEECH": "leech",
    "_EXTRA_ATTACKS": "extra_attacks",
    "_SPELL_BLOCK": "spell_block",
}


@dataclass
class RouteRegistry:
    """The routing rules; ``add``, ``add_prefix`` and ``add_suffix`` extend them.

    ``custom`` maps a family name to the fields of a user's layout.
    """

    extended: bool = False
    entries: dict[str, tuple[str, str, str]] = field(default_factory=dict)
    custom: dict[str, tuple[Field, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.prefixes, self.suffixes = dict(PREFIXES), dict(SUFFIXES)
        if self.extended:
            self.suffixes["_MISSED"] = "miss"
        table = {
            prefix + suffix: ("table", kind, family)
            for prefix, kind in self.prefixes.items()
            for suffix, family in self.suffixes.items()
        }
        special = {e: ("special", kind, family) for e, (kind, family) in SPECIAL.items()}
        alone = {e: ("standalone", "line", family) for e, family in STANDALONE.items()}
        own = {COMBATANT: ("combatant", "line", "combatant")}
        self.entries = {**table, **special, **alone, **own, **self.entries}

    def add(
        self, event: str, prefix: str, family: str, fields: list[Field] | None = None
    ) -> "RouteRegistry":
        """Route ``event``: prefix ``spell``, ``environment``, ``enchant``, ``none``
        (all after eight actor fields) or ``line`` (whole line, no actors)."""
        if prefix not in ("spell", "environment", "enchant", "none", "line"):
            raise ValueError(f"unknown prefix kind: {prefix}")
        route = "standalone" if prefix == "line" else "special"
        self.entries[event] = (route, prefix, family)
        if fields is not None:
            self.custom[family] = tuple(fields)
        return self

    def add_prefix(self, prefix: str, kind: str) -> "RouteRegistry":
        """Route ``prefix`` followed by every suffix, own ones included. ``kind`` is what stands
        behind the actors: ``spell``, ``environment``, ``enchant`` or ``none``."""
        if kind not in ("spell", "environment", "enchant", "none"):
            raise ValueError(f"unknown prefix kind: {kind}")
        self.prefixes[prefix] = kind
        for suffix, family in self.suffixes.items():
            self.entries[prefix + suffix] = ("table", kind, family)
        return self

    def add_suffix(
        self, suffix: str, family: str, fields: list[Field] | None = None
    ) -> "RouteRegistry":
        """Route every prefix of the prefix table followed by ``suffix``."""
        self.suffixes[suffix] = family
        for prefix, kind in self.prefixes.items():
            self.entries[prefix + suffix] = ("table", kind, family)
        if fields is not None:
            self.custom[family] = tuple(fields)
        return self

    def table(self, spark: SparkSession) -> DataFrame:
        """``(event, route, prefix, family)``: one row per known event name."""
        rows = ",".join(
            "('{}','{}','{}','{}')".format(*(v.replace("'", "''") for v in (e, *r)))
            for e, r in sorted(self.entries.items())
        )
        return spark.sql(f"select * from values {rows} as t(event, route, prefix, family)")


def route_events(headed: DataFrame, registry: RouteRegistry) -> DataFrame:
    """Add ``route``, ``prefix`` and ``family``; unknown names get route ``unparsed``.

    The table is a constant of the program, a few hundred rows, so it is broadcast.
    """
    table = registry.table(headed.sparkSession)
    joined = headed.join(F.broadcast(table), "event", "left")
    return joined.withColumn("route", F.coalesce("route", F.lit("unparsed")))
