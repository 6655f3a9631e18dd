"""Positional layouts of the payload families.

A layout lists ``Field(name, position, kind)``. Positions count from 0 after the event
prefix. ``kind`` is one of the names in ``KINDS`` or a ``Column -> Column`` function of
the raw field, so a user's own converter stays a native expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column


@dataclass(frozen=True)
class Field:
    name: str
    position: int
    kind: str | Callable[[Column], Column] = "raw"


@dataclass(frozen=True)
class Layout:
    """Fields of one family, and what happens when a line has too few of them."""

    fields: tuple[Field, ...]
    min_fields: int = 0
    error: str | None = None
    keeps_data: bool = False
    warning_label: str | None = None
    warning_reason: str | None = None


def _fields(kind_by_name: list[tuple[str, str]]) -> tuple[Field, ...]:
    return tuple(Field(name, i, kind) for i, (name, kind) in enumerate(kind_by_name))


# Field names, positions and kinds of each family; error texts.
_HIT = [
    ("amount", "int"),
    ("overkill", "int"),
    ("school", "int"),
    ("resisted", "int"),
    ("blocked", "int"),
    ("absorbed", "int"),
    ("critical", "bool"),
    ("glancing", "bool"),
    ("crushing", "bool"),
    ("is_off_hand", "bool"),
]
_MEND = [
    ("amount", "int"),
    ("overhealing", "int"),
    ("absorbed", "int"),
    ("critical", "bool"),
    ("multistrike", "bool"),
]
_TARGET = [("target_guid", "text"), ("target_name", "text")]

DAMAGE_SHORT = _fields(_HIT)
DAMAGE_LONG = _fields(_TARGET + _HIT + [("multistrike", "bool")])
DAMAGE_LONG_FROM = 10
HEAL_SHORT = _fields(_MEND)
HEAL_LONG = _fields(_TARGET + _MEND)
HEAL_LONG_FROM = 7

MISS = _fields(
    [
        ("missType", "text"),
        ("isOffHand", "bool"),
        ("amountMissed", "int"),
        ("amountAbsorbed", "int"),
        ("amountResisted", "int"),
    ]
)
ENERGIZE = _fields(
    [("amount", "float"), ("power_type", "raw"), ("extra_amount", "float"), ("max_power", "float")]
)


def _counted(label: str, kinds: list[tuple[str, str]]) -> Layout:
    n = len(kinds)
    return Layout(
        _fields(kinds), n, f"Insufficient {label} data", True, label, f">= {n} cols"
    )


LAYOUTS: dict[str, Layout] = {
    "drain": _counted(
        "DRAIN", [("amount", "int"), ("powerType", "power"), ("extraAmount", "int")]
    ),
    "leech": _counted("LEECH", [("amount", "int"), ("extraAmount", "int")]),
    "extra_attacks": _counted("EXTRA_ATTACKS", [("amount", "int")]),
    "spell_block": _counted(
        "SPELL_BLOCK",
        [("extraSpellId", "int"), ("extraSpellName", "text"), ("extraSchool", "int")],
    ),
    "aura": Layout(
        _fields([("auraType", "text"), ("amount", "int0_unless_nil")]),
        1, "No AURA data", False, "AURA", "No AURA data",
    ),
    "aura_refresh": Layout(
        _fields([("auraType", "text"), ("amount", "int0_unless_nil")]),
        1, "No aura refresh data", False, "AURA_REFRESH", "[auraType[, amount]]",
    ),
    "aura_dose": Layout(
        _fields([("auraType", "text"), ("newDose", "int0")]),
        2, "Incomplete AURA_DOSE data", True, "AURA_DOSE", "Incomplete AURA_DOSE data",
    ),
    "aura_broken_spell": Layout(
        _fields(
            [
                ("extraSpellId", "int0"),
                ("extraSpellName", "text"),
                ("extraSchool", "int0"),
                ("auraType", "text"),
            ]
        ),
        4, "No AURA_BROKEN data", False, "AURA_BROKEN", "No AURA_BROKEN data",
    ),
    "absorbed": Layout(
        _fields(
            [
                ("casterGuid", "raw"),
                ("casterName", "text"),
                ("absorbSpellId", "int0"),
                ("absorbSpellName", "text"),
                ("absorbedAmount", "int0"),
                ("totalAbsorbed", "int0"),
                ("isCritical", "bool0"),
            ]
        ),
        7, "No spell absorbed data", False, "SPELL_ABSORBED", "No spell absorbed data",
    ),
    "cast_failed": Layout(_fields([("failedType", "text")])),
    "encounter": Layout(
        _fields(
            [
                ("encounterId", "base10"),
                ("encounterName", "text"),
                ("difficultyId", "base10"),
                ("groupSize", "base10"),
            ]
        ),
        4, "Encounter data incomplete", False, "ENCOUNTER", "Encounter data incomplete",
    ),
    "arena_start": Layout(
        (
            Field("instanceId", 0, "text"),
            Field("instanceId_int", 0, "int"),
            Field("mapId", 1, "text"),
            Field("mapId_int", 1, "int"),
            Field("matchType", 2, "text"),
            Field("teamSize", 3, "text"),
            Field("teamSize_int", 3, "int"),
        ),
        4, "Arena start data incomplete",
    ),
    "arena_end": Layout(
        _fields(
            [
                ("winningTeamId", "base10"),
                ("matchDuration", "base10"),
                ("newRatingTeam1", "base10"),
                ("newRatingTeam2", "base10"),
            ]
        ),
        4, "Arena end data incomplete",
    ),
    "zone": Layout(
        (
            Field("zoneId", 1, "raw"),
            Field("zoneName", 2, "unquote_both"),
            Field("zoneFlag", 3, "raw"),
        ),
        3,
    ),
}

# Positions of each family that are read as integers; they are parsed once per row.
def int_positions(fields: tuple[Field, ...]) -> set[int]:
    return {
        f.position
        for f in fields
        if f.kind in ("int", "int0", "int0_unless_nil", "bool", "bool0", "power")
    }
