"""Log lines made from tables, to run the parser on data of any size.

Every rule is a Spark SQL expression over one row, so rendering needs no shuffle. The
line number is the row's own key: it grows through the file, and gaps stand for the blank
lines that a log may hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TIME = "date_format({}, 'M/d HH:mm:ss.SSSSSS')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly over the cluster's cores.

    Rows of some ten bytes become lines that take a thousand times as long to read. A small file is
    one or a few splits, however many cores there are, and its bytes do not tell AQE.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * cores))


def lines(rows: DataFrame, file: str, line_no: str, time: str, body: str, *keep: str) -> DataFrame:
    """``file, line_no, raw`` plus the ``keep`` columns; the time is followed by two blanks."""
    return rows.selectExpr(
        f"{file} as file",
        f"cast({line_no} as bigint) as line_no",
        f"concat({time}, '  ', {body}) as raw",
        *keep,
    )


def hex_of(n: str) -> str:
    return f"concat('0x', lower(hex({n})))"


def csv(*fields: str) -> str:
    return f"concat_ws(',', {', '.join(fields)})"


def actors(key: str) -> str:
    """Eight actor fields; all flag bits occur over the keys."""
    return csv(
        f"concat('Player-', {key})",
        f"concat('\"Src ', {key} % 100, '\"')",
        hex_of(f"({key} * 7919) % 1048576"),
        hex_of(f"{key} % 16"),
        f"concat('Creature-', {key} % 977)",
        f"concat('\"Dst ', {key} % 50, '\"')",
        f"cast(({key} * 104729) % 16777216 as string)",
        "'nil'",
    )


def spell(key: str) -> str:
    return csv(f"cast({key} % 1000 as string)", f"concat('\"Spell ', {key} % 1000, '\"')", hex_of(f"{key} % 128"))


# Event names of the rendered events, by event_id % 16.
SLOTS = [
    "SPELL_DAMAGE",
    "SPELL_HEAL",
    "SPELL_AURA_APPLIED",
    "SPELL_AURA_APPLIED_DOSE",
    "SPELL_ENERGIZE",
    "SPELL_DRAIN",
    "SPELL_ABSORBED",
    "SPELL_CAST_FAILED",
    "SPELL_CAST_SUCCESS",
    "SPELL_MISSED",
    "SWING_DAMAGE",
    "ENCHANT_APPLIED",
    "WORLD_MARKER_PLACED",
    "ZONE_CHANGE",
    "ARENA_MATCH_START",
    "SPELL_SUMMON",
]


def _case(slots: list[str]) -> str:
    cases = " ".join(f"when {i} then {expr}" for i, expr in enumerate(slots))
    return f"case event_id % 16 {cases} end"


def event_lines(events: DataFrame, *, with_faults: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One line per event; ``file`` is ``2024_<user>.txt``, the event name goes by id.

    ``with_faults`` turns some lines bad by user and id: malformed lines (users ending in
    7 and 8), malformed combatant lines (9), fatal lines (6), short summon lines, and
    drain lines with too few fields.
    """
    a, s = actors("event_id"), spell("event_id")
    amount = "cast(cast(round(value * 100) as bigint) as string)"
    n = lambda e: f"cast({e} as string)"
    swing = "'nil,nil,nil,1,nil,nil'"
    drain = csv(amount, n("event_id % 20"), "'nil'")
    summon = f"concat_ws(',', {a}, {s})"
    if with_faults:
        drain = f"if(event_id % 5 = 0, {n('event_id % 3')}, {drain})"
        summon = f"if(event_id % 3 = 0, concat_ws(',', {a}, '1'), {summon})"
    bodies = [
        csv(f"'{SLOTS[0]}'", a, s, amount, "'-1'", hex_of("event_id % 128"), "'0,0,0,1,nil,nil'"),
        csv(f"'{SLOTS[1]}'", a, s, amount, "'0'", "'0'", "'nil'"),
        csv(f"'{SLOTS[2]}'", a, s, "'BUFF'"),
        csv(f"'{SLOTS[3]}'", a, s, "'DEBUFF'", n("event_id % 10")),
        csv(f"'{SLOTS[4]}'", a, s, n("value"), "'3'", "'0'", "'100'"),
        csv(f"'{SLOTS[5]}'", a, s, drain),
        csv(f"'{SLOTS[6]}'", a, s, "'Player-9'", "'\"Caster\"'", "'17'", "'\"Shield\"'", amount, amount, n("event_id % 2")),
        csv(f"'{SLOTS[7]}'", a, s, "'\"Not ready\"'"),
        csv(f"'{SLOTS[8]}'", a, s),
        csv(f"'{SLOTS[9]}'", a, s, "'ABSORB'", "'nil'", amount),
        csv(f"'{SLOTS[10]}'", a, amount, "'-1'", "'1'", swing),
        csv(f"'{SLOTS[11]}'", a, "'\"Sharp\"'", n("event_id % 5000"), "'\"Sword\"'"),
        csv(f"'{SLOTS[12]}'", n("event_id % 900"), n("event_id % 8"), n("value"), n("-value")),
        csv(f"'{SLOTS[13]}'", "'0'", n("event_id % 3000"), "'\"Zone\"'", "'0'"),
        csv(f"'{SLOTS[14]}'", "'1552'", n("event_id % 40"), "'\"2v2\"'", "'1'"),
        csv(f"'{SLOTS[15]}'", summon),
    ]
    time = TIME.format("ts")
    body = _case(bodies)
    if with_faults:
        body = f"""case
            when user_id % 10 = 7 and event_id % 29 = 0 then 'SWING_DAMAGE,a,b'
            when user_id % 10 = 8 and event_id % 97 = 0 then 'ARENA_MATCH_END,x,1,2,3'
            when user_id % 10 = 9 and event_id % 61 = 0 then 'COMBATANT_INFO,Player-1,1'
            when user_id % 10 = 6 and event_id % 53 = 0 then concat_ws(',', 'SPELL_CAST_FAILED', {a}, {s})
            else {body} end"""
    return lines(
        events, "concat('2024_', user_id, '.txt')", "event_id + 1", time, body, *keep
    )


LINE_KEY = "(l_orderkey * 8 + l_linenumber)"


def item_lines(lineitem: DataFrame, event: str, *fields: str, prefix: str = "spell") -> DataFrame:
    """One line of one event per line item: actors, the spell unless ``prefix`` is none,
    then the given payload fields."""
    head = [actors(LINE_KEY)] + ([spell(LINE_KEY)] if prefix == "spell" else [])
    body = csv(f"'{event}'", *head, *fields)
    return lines(
        lineitem, "'2024_items.txt'", LINE_KEY, TIME.format("l_shipdate"), body, "l_orderkey"
    )


def plain_lines(rows: DataFrame, event: str, key: str, *fields: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One line of an event without actors per row."""
    return lines(rows, "'2024_plain.txt'", key, "'4/22 05:27:15.478'", csv(f"'{event}'", *fields), *keep)


def combatant_lines(customer: DataFrame, part: DataFrame) -> DataFrame:
    """One combatant line per part, with the customer of the same key; its key stands in for a missing one.

    Old talents for odd keys, new ones for even keys; the four shapes of expansion powers
    by key modulo 4 (2 is none).
    """
    rows = part.join(customer.select("c_custkey"), customer.c_custkey == part.p_partkey, "left")
    rows = spread(rows.select(F.coalesce("c_custkey", "p_partkey").alias("c_custkey"), "p_partkey", "p_size"))
    c, p, z = "c_custkey", "p_partkey", "p_size"
    stats = ", ".join(f"cast(({c} * {i + 3}) % 1000 as string)" for i in range(21))
    body = f"""concat_ws(',', 'COMBATANT_INFO', concat('Player-', {c}), cast({c} % 2 as string), {stats},
        cast({c} % 300 as string),
        if({c} % 2 = 0, concat('[(', {c}, ',', {c} + 1, ',1),(', {c} + 2, ',', {c} + 3, ',2)]'),
           concat('(', {c}, ',', {c} + 1, ',', {c} + 2, ')')),
        concat('(0,', {c}, ',', {c} + 1, ',5)'),
        case {c} % 4
          when 0 then concat('[', {c} % 20, ',1,[(', {c}, ',335,1),(7,8,2)],[(1379),(', {c},
                             ')],[(233,200),(', {c}, ',213)]]')
          when 1 then concat('[10,1,', {c}, ',2]')
          when 3 then concat('[1,2,', {c}, ']') end,
        concat('[(', {p}, ',', {z}, ',(),(1479,', {z}, '),()),(', {c}, ',90,(0,0,4223),(6707),(5,6,7))]'),
        concat('[Player-', {c}, ',295365,Player-', {c}, ',', {c}, ']'),
        cast({c} % 50 as string), '1', cast({c} % 3000 as string), cast({c} % 6 as string))"""
    return lines(rows, "'2024_people.txt'", c, "'4/22 05:27:15.478'", body)
