import json

import pytest
from pyspark.sql import functions as F

from linewright import Field, RouteRegistry, event_json, parse_combatants, parse_events

A8 = 'Player-1,"Src",0x511,0x0,Creature-2,"Dst",0x10a48,0x0'


@pytest.fixture
def one(lines):
    def parse(text, **options):
        return parse_events(lines(text), **options).first().asDict(recursive=True)

    return parse


@pytest.fixture
def many(lines):
    """Rows of many texts from one parse."""

    def parse(texts):
        rows = parse_events(lines(*texts)).orderBy("line_no").collect()
        return [r.asDict(recursive=True) for r in rows]

    return parse


def present(d):
    return {k: v for k, v in d.items() if v is not None}


def test_damage_short_and_long(one):
    tail = "500,-1,4,nil,nil,nil,1,nil,nil"
    row = one(f'SPELL_DAMAGE,{A8},133,"Fireball",0x4,{tail}')
    assert row["status"] == "ok" and row["route"] == "table"
    assert present(row["damage"]) == {
        "amount": 500, "overkill": -1, "school": 4, "critical": True, "schoolNames": ["FIRE"],
    }
    assert row["spell"] == {
        "spellId": 133, "spellName": "Fireball", "spellSchool": 4, "spellSchoolNames": ["FIRE"],
    }
    assert row["actors"]["sourceFlags"] == [
        "AFFILIATION_MINE", "REACTION_FRIENDLY", "CONTROL_PLAYER", "TYPE_PLAYER",
    ]
    long = one(f'SPELL_DAMAGE,{A8},133,"Fireball",0x4,{tail},0')["damage"]
    assert long["target_guid"] == "500" and long["target_name"] == "-1" and long["amount"] == 4


PAYLOADS = [
    (f'DAMAGE_SHIELD_MISSED,{A8},1,"X",0x1,ABSORB,nil,0,7,3', "miss",
     {"missType": "ABSORB", "amountMissed": 3, "amountAbsorbed": 7, "amountResisted": 3}),
    (f'SPELL_ENERGIZE,{A8},1,"X",0x1,10,3,0,100', "energize",
     {"amount": 10.0, "power_type": "unknown", "extra_amount": 0.0, "max_power": 100.0}),
    (f'SPELL_DRAIN,{A8},1,"X",0x1,10,3,nil', "drain", {"amount": 10, "powerType": "energy"}),
    (f'SPELL_AURA_APPLIED,{A8},1,"X",0x1,BUFF', "aura", {"auraType": "BUFF"}),
    (f'SPELL_AURA_APPLIED,{A8},1,"X",0x1,BUFF,NIL', "aura", {"auraType": "BUFF", "amount": 0}),
    (f'SPELL_HEAL,{A8},1,"X",0x1,9,1,nil,1', "heal",
     {"amount": 9, "overhealing": 1, "critical": True}),
    ('ARENA_MATCH_START,1552,3,"2v2",1', "arena_start",
     {"instanceId": "1552", "instanceId_int": 1552, "mapId": "3", "mapId_int": 3,
      "matchType": "2v2", "teamSize": "1", "teamSize_int": 1}),
    ("WORLD_MARKER_REMOVED,SKULL", "world_marker", {"removed": True, "flag": "SKULL"}),
    ("WORLD_MARKER_PLACED,1,2,3.5,x,4", "world_marker",
     {"mapId": 1, "markerId": 2, "x": 3.5, "y": 0.0, "z": 4.0}),
    ('ZONE_CHANGE,0,1552,"Nagrand",0', "zone",
     {"zoneId": "1552", "zoneName": "Nagrand", "zoneFlag": "0"}),
    ('ENCOUNTER_END,7,"Boss",016,20', "encounter",
     {"encounterId": 7, "encounterName": "Boss", "difficultyId": 16, "groupSize": 20}),
    (f'SPELL_CAST_SUCCESS,{A8},17,"Po,wer",0x2', "spell",
     {"spellId": 17, "spellName": "Po", "spellSchool": 0, "spellSchoolNames": []}),
]


def test_payloads(many):
    for row, (text, column, expected) in zip(many([c[0] for c in PAYLOADS]), PAYLOADS, strict=True):
        assert row["status"] == "ok" and row["error"] is None, text
        assert present(row[column]) == expected, text


STATUSES = [
    (f'SPELL_DRAIN,{A8},1,"X",0x1,10', "ok", "Insufficient DRAIN data"),
    (f'SPELL_CAST_FAILED,{A8},1,"X",0x1', "fatal", None),
    (f"ENVIRONMENTAL_DAMAGE,{A8}", "fatal", None),
    (f"SPELL_SUMMON,{A8},1", "dropped", None),
    ("SPELL_SUMMON,a", "dropped", None),
    ("SWING_DAMAGE,a,b", "malformed", None),
    ("ENCHANT_APPLIED,a,b", "malformed", None),
    ('ENCOUNTER_START,x,"Boss",16,20', "ok",
     "Failed to parse ENCOUNTER data: invalid literal for int() with base 10: 'x'"),
    ("ENCOUNTER_START,1", "ok", "Encounter data incomplete"),
    ("ARENA_MATCH_END,x,1,2,3", "malformed", None),
    ("ARENA_MATCH_END,1", "ok", "Arena end data incomplete"),
    ("ZONE_CHANGE,a", "ok", "Invalid format for ZONE_CHANGE: ['a']"),
    ("WORLD_MARKER_PLACED,1,2", "ok", "Insufficient data for WORLD_MARKER"),
    (f"SPELL_DAMAGE,{A8},133", "ok", "Spell data incomplete"),
    (f"SPELL_AURA_APPLIED_DOSE,{A8},133", "ok", "Incomplete AURA_DOSE data"),
    (f'SPELL_AURA_BROKEN_SPELL,{A8},1,"X",1,2', "ok", "No AURA_BROKEN data"),
    (f'SPELL_ABSORBED,{A8},1,"X",1,2', "ok", "No spell absorbed data"),
    ("spell_damage,a", "ok", None),
    (",a", "malformed", None),
    ("COMBATANT_INFO,Player-1,1", "malformed", None),
]


def test_statuses(many):
    for row, (text, status, error) in zip(many([c[0] for c in STATUSES]), STATUSES, strict=True):
        assert (row["status"], row["error"]) == (status, error), text


def test_short_spell_prefix_consumes_nothing(one):
    row = one(f"SPELL_DAMAGE,{A8},133,7")
    assert row["raw_cols"] == ["133", "7"] and row["damage"]["amount"] == 133


def test_unparsed_and_options(one):
    text = f'SPELL_MISSED,{A8},1,"X",0x1,ABSORB'
    row = one(text)
    assert len(row["unparsed_params"]) == 12 and row["route"] == "unparsed"
    assert one(text, extended_routes=True)["miss"]["missType"] == "ABSORB"
    fixed = one(f'SPELL_ENERGIZE,{A8},1,"X",0x1,10,3,0,100', fix_power_type=True)
    assert fixed["energize"]["power_type"] == "energy"


def test_own_layout(one):
    registry = RouteRegistry().add(
        "GUILD_NOTE", "line", "note",
        [Field("who", 0, "text"), Field("n", 1, "int"), Field("loud", 2, F.upper)],
    )
    row = one('GUILD_NOTE,"Ann",0x10,hey', registry=registry)
    assert row["note"] == {"who": "Ann", "n": 16, "loud": "HEY"} and row["status"] == "ok"
    with pytest.raises(ValueError):
        RouteRegistry().add("X", "other", "y")


LEGACY = (
    "COMBATANT_INFO,Player-9,1," + ",".join(["5"] * 21) + ",257,(1,2,3),(0,7,8,9),"
    "[0,0,[],[],[]],[(173845,90,(),(1479,4786),()),(1,2,7,(6707),(5,6,7))],"
    "[Player-9,295365,Player-9,x,odd],1,0,0,0"
)


def test_combatant_legacy(lines):
    row = parse_combatants(parse_events(lines(LEGACY))).first().asDict(recursive=True)
    assert row["player"] == {"guid": "Player-9", "faction": 1} and row["stats"]["spec_id"] == 257
    assert row["class_talents"]["ids"] == [1, 2, 3] and row["pvp_talents"] == [0, 7, 8, 9]
    assert row["expansion_powers"]["kind"] == "shadowlands"
    assert row["equipment"][1] == {
        "item_id": 1, "item_level": 2, "enchants": [7], "bonus_list": [6707],
        "gems": [{"id": 5, "item_level": 6}, {"id": 7, "item_level": None}],
    }
    assert row["interesting_auras"] == [
        {"caster_guid": "Player-9", "spell_id": "295365", "spell_id_int": 295365},
        {"caster_guid": "Player-9", "spell_id": "x", "spell_id_int": None},
    ]
    assert row["pvp_stats"] == {"honor_level": 1, "season": 0, "rating": 0, "tier": 0}


def combatant(talents="(1,2)", pvp="(0,1)", powers=None, gear="[(1,2,(),(),())]", tail=",[],1,2,3,4"):
    head = "COMBATANT_INFO,P,1," + ",".join(["5"] * 22)
    return f"{head},{talents},{pvp}" + (f",{powers}" if powers else "") + f",{gear}{tail}"


SHAPES = [
    (combatant(), "none"),
    (combatant(powers="[]"), "artifact"),
    (combatant(powers="[10,1,11,2]"), "artifact"),
    (combatant(powers="[(10),(1)]"), "artifact"),
    (combatant(powers="[1,2,3]"), "other"),
    (combatant(powers="[18,1,[(343203,335,1)],[(1379),(1380)],[(233,200)]]"), "shadowlands"),
    (combatant(talents="[,(1,2,3),(4,5,6)]"), "none"),
    (combatant(pvp="7"), "none"),
    (combatant(tail=""), "none"),
]


def test_expansion_shapes(many):
    for row, (text, kind) in zip(many([c[0] for c in SHAPES]), SHAPES, strict=True):
        assert row["status"] == "ok", text
        assert row["combatant"]["expansion_powers"]["kind"] == kind, text


FAULTS = [
    (combatant(talents="(5)"), "fatal"),
    (combatant(talents="[(1,2)]"), "fatal"),
    (combatant(talents="[1,2]"), "fatal"),
    (combatant(talents="(1,x)"), "malformed"),
    (combatant(pvp="(1,(2,3))"), "fatal"),
    (combatant(pvp="(1"), "malformed"),
    (combatant(powers="[1,2"), "malformed"),
    (combatant(powers="[1,2,[],[],[5]]"), "fatal"),
    (combatant(powers="[]", gear="[5]"), "fatal"),
    (combatant(gear="[(5,)]"), "malformed"),
    (combatant(gear="7"), "malformed"),
    (combatant(tail=",[],1,2"), "malformed"),
    (combatant(tail=",[],1,2,x,4"), "malformed"),
    (combatant().replace("P,1,", "P,x,"), "malformed"),
]


def test_combatant_faults(many):
    for row, (text, status) in zip(many([c[0] for c in FAULTS]), FAULTS, strict=True):
        assert row["status"] == status, text


def test_export(spark, lines):
    events = parse_events(
        lines(
            f'SPELL_DRAIN,{A8},1,"X",0x1,10,3,nil',
            f'DAMAGE_SHIELD_MISSED,{A8},1,"X",0x1,ABSORB',
            'ARENA_MATCH_START,1552,map,"2v2",1,"e"',
            LEGACY,
            f'SPELL_DRAIN,{A8},1,"X",0x1,10',
            f'SPELL_DAMAGE,{A8},1,"X",0x1,' + ",".join(["1"] * 20),
        )
    )
    out = [json.loads(r.j) for r in events.selectExpr("line_no", f"{event_json(events)} as j").orderBy("line_no").collect()]
    assert out[0]["powerType"] == "energy" and out[0]["extraAmount"] is None and "school" not in out[0]
    assert out[0]["timestamp"] == 1713763635.478 and out[0]["sourceGUID"] == "Player-1"
    assert out[1]["missType"] == "ABSORB" and out[1]["amountMissed"] is None
    assert (out[2]["instanceId"], out[2]["mapId"], out[2]["teamSize"]) == (1552, "map", 1)
    assert out[2]["extraFields"] == ["e"]
    assert out[3]["class_talents"] == [1, 2, 3] and out[3]["pvp_stats"]["Honor Level"] == 1
    assert out[3]["interesting_auras"][1] == {"caster_guid": "Player-9", "spell_id": "x"}
    assert out[3]["expansion_powers"]["anima_powers"] == []
    assert out[3]["equipment"][1]["gems"][1] == {"id": 7, "item_level": None}
    assert out[4]["error"] == "Insufficient DRAIN data" and out[4]["data"] == ["10"]
    assert out[5]["amount"] == 1 and "extra" not in out[5]
