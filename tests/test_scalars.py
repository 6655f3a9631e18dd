import pytest
from pyspark.sql import functions as F

from linewright.functions import flags, scalars
from linewright.functions.nested import literal_json, split_nested, tidy_literal
from linewright.functions.text import quoted_list, strip, unquote


def values(spark, expr, *inputs):
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    return [r.v for r in rows.selectExpr("i", f"{expr} as v").orderBy("i").collect()]


INPUTS = ["512", "0x512", "-1", "0", "0123", "12.5", "nil", "NIL", "True", "1.0d", "00", "+7",
          "0b101", "0o17", "-0X1F", "9223372036854775807", "9223372036854775808", "", "0x", None]


def test_int(spark):
    assert values(spark, scalars.as_int("x"), *INPUTS) == [
        512, 1298, -1, 0, None, None, None, None, None, None, 0, 7,
        5, 15, -31, 9223372036854775807, None, None, None, None,
    ]
    assert values(spark, scalars.as_int("x", 0), "0123", "nil", "7") == [0, 0, 7]
    assert values(spark, scalars.as_flag_int("x"), *INPUTS[:4], "zz") == [512, 1298, -1, 0, 0]


def test_bool(spark):
    assert values(spark, scalars.as_bool("x"), "512", "0", "-1", "0123", "nil", "True") == [
        True, False, True, None, None, None,
    ]


def test_float(spark):
    got = values(spark, scalars.as_float("x"), "512", "0x512", "-1", "0123", "12.5", "nil", "1.0d",
                 "1f", ".5", "5.", "1e3", "inf", "-Infinity", "abc")
    assert got == [512.0, None, -1.0, 123.0, 12.5, None, None, None, 0.5, 5.0, 1000.0,
                   float("inf"), float("-inf"), None]
    assert str(values(spark, scalars.as_float("x"), "NaN")[0]) == "nan"


def test_base10(spark):
    assert values(spark, scalars.base10_int("x"), "05", "+3", "0x5", "1.5", "nil", "") == [
        5, 3, None, None, None, None,
    ]


def test_text(spark):
    assert values(spark, unquote("x"), '"Bob"', '""x""', "nil") == ["Bob", "x", "nil"]
    assert values(spark, strip("x"), "\t a b ", "\x1cx　") == ["a b", "x"]
    made = values(spark, quoted_list("split(x, ',')"), "a,b", "it's", "\"q\"'s")
    assert made == [str(["a", "b"]), str(["it's"]), str(["\"q\"'s"])]


@pytest.mark.parametrize(
    "text, names",
    [
        ("0x0548", "AFFILIATION_OUTSIDER REACTION_HOSTILE CONTROL_PLAYER TYPE_PLAYER"),
        ("0x1148", "AFFILIATION_OUTSIDER REACTION_HOSTILE CONTROL_PLAYER TYPE_PET"),
        ("0x1248", "AFFILIATION_OUTSIDER REACTION_HOSTILE CONTROL_NPC TYPE_PET"),
        ("0xFF000000", ""),
        ("nil", ""),
        ("0x800000", "NONE"),
    ],
)
def test_unit_flags(spark, text, names):
    got = values(spark, flags.unit_flag_names(scalars.as_flag_int("x")), text)
    assert got == [names.split()]


def test_schools_and_powers(spark):
    assert values(spark, flags.school_names(scalars.as_int("x", 0)), "0x14", "0") == [["FIRE", "FROST"], []]
    assert values(spark, flags.power_type_name(scalars.as_int("x")), "-2", "3", "14", "19", "20", "x") == [
        "health", "energy", "unknown", "essence", "unknown", "unknown",
    ]


def brute_split(text):
    out, piece, square, paren = [], "", 0, 0
    for ch in text:
        square = max(0, square + (ch == "[") - (ch == "]"))
        paren = max(0, paren + (ch == "(") - (ch == ")"))
        if ch == "," and not square and not paren:
            out.append(piece)
            piece = ""
        else:
            piece += ch
    return [p.strip() for p in [*out, piece]]


def test_split_nested_matches_a_character_scan(spark):
    import random

    rng = random.Random(3)
    texts = ["a,(b,c),[d,(e,f)],g", "", ",", "x]),y,(z", "[,(1,2)],3"]
    texts += ["a,[[[[[1]]]]],b", "((((((x,y)))))),z"]
    texts += ["".join(rng.choice("ab,,[]()") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    assert values(spark, split_nested("x"), *texts) == [brute_split(t) for t in texts]


def test_literals(spark):
    got = values(spark, literal_json(tidy_literal("x")), "[(1,2),(3)]", "(5)", "(5,)", "[]", "[1,2", "(1]",
                 "[ +1 , -2 ]", "[1 2]", "[05]", "[1,]", "[,]", "['a']", "((((7))))", "((1,2))", "[1.5,.5,2.]",
                 "[00, None, True]", "(1)(2)", "[" * 15 + "9" + "]" * 15, "['(x], y']")
    assert got == ["[[1,2],3]", "5", "[5]", "[]", None, None, "[1,-2]", None, None, "[1]", None, '["a"]', "7", "[1,2]",
                   "[1.5,0.5,2.0]", "[0,null,true]", None, "[" * 15 + "9" + "]" * 15, r'["\u0028x\u005d\u002c y"]']


def test_line_hash(spark, lines):
    import hashlib

    from linewright import with_line_hash

    row = with_line_hash(lines("X,1"), "blake2s").first()
    assert row.lh == hashlib.blake2s(row.raw.encode(), digest_size=4).hexdigest()
    assert with_line_hash(lines("X,1")).select(F.length("line_sha")).first()[0] == 8
