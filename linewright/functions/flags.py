"""Bit sets to lists of names.

The bits fall into runs of neighbours. Each run has one small constant table with the
name list of every combination, so decoding is a shift, a mask and a lookup per run.
"""

from __future__ import annotations

# Unit flag names and bits, in output order.
UNIT_FLAGS = [
    ("AFFILIATION_MINE", 0x1),
    ("AFFILIATION_PARTY", 0x2),
    ("AFFILIATION_RAID", 0x4),
    ("AFFILIATION_OUTSIDER", 0x8),
    ("REACTION_FRIENDLY", 0x10),
    ("REACTION_NEUTRAL", 0x20),
    ("REACTION_HOSTILE", 0x40),
    ("CONTROL_PLAYER", 0x100),
    ("CONTROL_NPC", 0x200),
    ("TYPE_PLAYER", 0x400),
    ("TYPE_NPC", 0x800),
    ("TYPE_PET", 0x1000),
    ("TYPE_GUARDIAN", 0x2000),
    ("TYPE_OBJECT", 0x4000),
    ("TARGET", 0x10000),
    ("FOCUS", 0x20000),
    ("MAINTANK", 0x40000),
    ("MAINASSIST", 0x80000),
    ("NONE", 0x800000),
]

# Spell school names and bits, in output order.
SCHOOLS = [
    ("PHYSICAL", 0x1),
    ("HOLY", 0x2),
    ("FIRE", 0x4),
    ("NATURE", 0x8),
    ("FROST", 0x10),
    ("SHADOW", 0x20),
    ("ARCANE", 0x40),
]

# Power type codes and names.
POWER_TYPES = {
    -2: "health",
    0: "mana",
    1: "rage",
    2: "focus",
    3: "energy",
    4: "combo points",
    5: "runes",
    6: "runic power",
    7: "soul shards",
    8: "lunar power",
    9: "holy power",
    10: "alternate",
    11: "maelstrom",
    12: "chi",
    13: "insanity",
    16: "arcane charges",
    17: "fury",
    18: "pain",
    19: "essence",
}


def _name_array(names: list[str]) -> str:
    if not names:
        return "cast(array() as array<string>)"
    return "array(" + ",".join(f"'{n}'" for n in names) + ")"


def _runs(members: list[tuple[str, int]]) -> list[list[tuple[str, int]]]:
    runs: list[list[tuple[str, int]]] = []
    for name, bit in members:
        if runs and runs[-1][-1][1] * 2 == bit:
            runs[-1].append((name, bit))
        else:
            runs.append([(name, bit)])
    return runs


def bit_names(flag: str, members: list[tuple[str, int]]) -> str:
    """Names of the set bits, in member order. ``flag`` is a BIGINT expression."""
    parts = []
    for run in _runs(members):
        shift = run[0][1].bit_length() - 1
        table = ",".join(
            _name_array([name for i, (name, _) in enumerate(run) if combo >> i & 1])
            for combo in range(1 << len(run))
        )
        mask = (1 << len(run)) - 1
        parts.append(f"get(array({table}), cast(shiftright({flag}, {shift}) & {mask}L as int))")
    return parts[0] if len(parts) == 1 else f"concat({','.join(parts)})"


def unit_flag_names(flag: str) -> str:
    return bit_names(flag, UNIT_FLAGS)


def school_names(school: str) -> str:
    return bit_names(school, SCHOOLS)


def power_type_name(code: str) -> str:
    """Name of a power type code, ``unknown`` when not listed or null."""
    low, high = min(POWER_TYPES), max(POWER_TYPES)
    names = ",".join(f"'{POWER_TYPES.get(k, 'unknown')}'" for k in range(low, high + 1))
    return (
        f"coalesce(case when {code} between {low} and {high} "
        f"then get(array({names}), cast({code} - {low} as int)) end, 'unknown')"
    )
