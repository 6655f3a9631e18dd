"""Work per row and over the cores stays in proportion to the input."""

import random

import linewright as L
from linewright.functions.nested import literal_json, split_nested, tidy_literal
from linewright.plans import render as R

SF = "/root/testdata/sf0.001"


def test_combatant_lines_of_one_split_reach_all_cores(spark):
    made = R.combatant_lines(R.table(spark, SF, "customer"), R.table(spark, SF, "part"))
    cores = spark.sparkContext.defaultParallelism
    assert made.rdd.getNumPartitions() >= cores
    sizes = made.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes) <= 2 * sum(sizes) / cores


def test_a_literal_is_read_once():
    """The rule of a literal is in the text of its JSON once, so it is run once."""
    assert literal_json("LITERAL").count("LITERAL") == 1


def test_long_aura_lists_in_linear_time(spark):
    """The list is cut once, not once for every pair."""
    from linewright.operators.combatant import _pairs

    assert _pairs("VALUES", "a", "b", True).count("VALUES") == 1
    odd = spark.range(1).selectExpr(f"to_json({_pairs('array(1, 2, 3)', 'a', 'b', False)}) as whole", f"to_json({_pairs('array(1, 2, 3)', 'a', 'b', True)}) as odd").first()
    assert tuple(odd) == ('[{"a":1,"b":2}]', '[{"a":1,"b":2},{"a":3}]')


def _split(text):
    """split_nested by hand."""
    done, piece, square, paren = [], None, 0, 0
    for x in text.split(","):
        if piece is not None and not square and not paren:
            done.append(piece)
            piece = x
        else:
            piece = x if piece is None else f"{piece},{x}"
        for c in x:
            square = max(square + (c == "[") - (c == "]"), 0)
            paren = max(paren + (c == "(") - (c == ")"), 0)
    return [x.strip() for x in [*done, piece]]


def test_regular_and_odd_texts_are_cut_alike(spark):
    """Texts with closed brackets take a short way; the cuts are those of the bracket counts."""
    rng = random.Random(3)
    parts = ["[", "]", "(", ")", ",", ",", "1", "a b", " ", "(5)", "[1,2]", "[(1,2),[3,(4)]]", "\n"]
    texts = ["", ",", "a,", ",a", "[[[[[[1,2]]]]]],3", "[(1,2),(3,[4,5])],x,,[]"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").selectExpr("i", f"{split_nested('t')} as got")
    assert [r.got for r in rows.orderBy("i").collect()] == [_split(t) for t in texts]


def test_tidy_literals(spark):
    want = {
        "[1,2]": "[1,2]", "[(1,2,(),(3,4),()),(-5,6)]": "[(1,2,(),(3,4),()),(-5,6)]", "[(1479),(7)]": "[1479,7]", "((5))": "5", "(5,)": "(5)",
        "5(6)": None, "(5)6": None, "[1,]": "[1]", "[,1]": None, "[1\n]": "[1]", "[1]\n": "[1]", "[01]": None, "[-0,00]": "[0,0]", "[1 2]": None, "[1": None, "1,2": None, "": None,
        "[[[[[[1]]]]]]": "[[[[[[1]]]]]]",
    }
    rows = spark.createDataFrame(list(enumerate(want)), "i int, t string").selectExpr("i", f"{tidy_literal('t')} as got")
    assert dict(zip(want, [r.got for r in rows.orderBy("i").collect()])) == want


def test_many_auras(spark, lines):
    rendered = R.combatant_lines(R.table(spark, SF, "customer"), R.table(spark, SF, "part")).limit(1).first()
    auras = ",".join(f"Player-{k},{k}" for k in range(400))
    head, tail = rendered.raw.split(",[Player-")
    line = f"{head},[{auras}]{tail[tail.index(']') + 1:]}"
    found = L.parse_combatants(L.parse_events(lines(line))).first()
    assert [a.spell_id_int for a in found.interesting_auras] == list(range(400))


def test_an_object_is_written_once():
    """The members of a JSON object need its text in several places, its rule only once."""
    from linewright.sources.events import _members

    assert _members("OBJECT").count("OBJECT") == 1


def test_members_of_objects(spark):
    from linewright.sources.events import _members

    rows = spark.createDataFrame([("{}",), ('{"a":1}',), ('{"a":{}}',), (None,)], "j string")
    assert [r.m for r in rows.selectExpr(f"{_members('j')} as m").collect()] == [None, '"a":1', '"a":{}', None]


def test_head_actors_and_spell_are_read_in_one_pass(spark):
    """One parse of the text for what most events hold; a family of its own is parsed where it occurs."""
    plan = L.typed_events(spark.createDataFrame([], "value string"))._jdf.queryExecution().analyzed().toString()
    parses = [x for x in plan.split("from_json(")[1:] if "sourceGUID" in x.split("from_json(")[0][:4000] and "StructField(sourceGUID" in x[:4000]]
    assert len(parses) == 1 and "StructField(timestamp" in parses[0][:400] and "StructField(spellName" in parses[0][:4000]


def test_exported_events_of_one_split_reach_all_cores(spark):
    from linewright.plans.contract import QUERIES

    out = QUERIES["event_export"](spark, SF)
    assert out.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
