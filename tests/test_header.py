from datetime import datetime, timezone

from linewright import parse_header


def micros(spark, text, file="log.txt", **options):
    df = spark.createDataFrame([(file, 1, text)], "file string, line_no bigint, raw string")
    row = parse_header(df, **options).selectExpr("*", "unix_micros(event_time) as us").first()
    return row


def at(*parts):
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp() * 1e6)


GOOD = 1713763635478000


TIMES = [
    ("4/22 05:27:15.478  X,1", "2024_a.txt", GOOD),
    ("4/22 05:27:15.478  X,1", "a.txt", 1682141235478000),
    ("4/22 05:27:15.478  X,1", "1969_a.txt", 1682141235478000),
    ("4/22/24 5:27:15.478 X", "2019_a.txt", GOOD),
    ("4/22/99 05:27:15.478 X", "a.txt", at(1999, 4, 22, 5, 27, 15, 478000)),
    ("4/22/69 05:27:15.478 X", "a.txt", at(2069, 4, 22, 5, 27, 15, 478000)),
    ("4/22/70 05:27:15.478 X", "a.txt", at(1970, 4, 22, 5, 27, 15, 478000)),
    ("4/22/2024 05:27:15.478-5 X", "a.txt", GOOD),
    ("4/22/2024 05:27:15.478+05:30 X", "a.txt", GOOD),
    ("4/22/2024/9 05:27:15.478 X", "a.txt", GOOD),
    ("  4/22/2024\t05:27:15.478 X", "a.txt", GOOD),
    ("4/22/2024   05:27:15.478   X", "a.txt", GOOD),
    ("04/22/2024 05:27:15.478 X", "a.txt", GOOD),
    ("4/22 05:27:15  X", "a.txt", None),
    ("2/30 05:27:15.1 X", "a.txt", None),
    ("4/22 24:00:00.1 X", "a.txt", None),
    ("4/22 05:27:60.0 X", "a.txt", None),
    ("4/22 05:27:15.1234567 X", "a.txt", None),
    ("4/22/123 05:27:15.1 X", "a.txt", None),
    ("4 05:27:15.1 X", "a.txt", None),
    ("a/b 05:27:15.1 X", "a.txt", None),
    ("2/29 05:27:15.1 X", "a.txt", None),
    ("   ", "a.txt", None),
    ("4/22 05:27:15.478", "a.txt", None),
    ("4/22 05:27:15.478   ", "a.txt", None),
]


def test_times(spark):
    rows = [(file, i, text) for i, (text, file, _) in enumerate(TIMES)]
    df = spark.createDataFrame(rows, "file string, line_no bigint, raw string")
    got = parse_header(df).selectExpr("*", "unix_micros(event_time) as us").orderBy("line_no").collect()
    for row, (text, _, expected) in zip(got, TIMES, strict=True):
        assert row.us == expected, text
        assert (row.header_error is None) == (expected is not None), text


def test_year_guess_against_now(spark):
    row = micros(spark, "12/31 00:00:00.0 X", now=datetime(2023, 1, 15))
    assert row.us == at(2022, 12, 31)
    assert micros(spark, "12/31 00:00:00.0 X", "2024_a.txt", now=datetime(2023, 1, 15)).us == at(2024, 12, 31)
    # exactly 180 whole days ahead stays, 181 does not
    assert micros(spark, "6/30 23:00:00.0 X", now=datetime(2023, 1, 1)).us == at(2023, 6, 30, 23)
    assert micros(spark, "7/1 00:00:00.0 X", now=datetime(2023, 1, 1)).us == at(2022, 7, 1)


def test_zone_and_dst(spark):
    from zoneinfo import ZoneInfo

    for wall in [(2024, 3, 10, 2, 30), (2024, 11, 3, 1, 30), (2024, 7, 1, 12, 0)]:
        y, mo, d, h, mi = wall
        row = micros(spark, f"{mo}/{d}/{y} {h}:{mi}:00.5 X", log_tz="America/New_York")
        expected = datetime(*wall, 0, 500000, tzinfo=ZoneInfo("America/New_York")).timestamp()
        assert row.timestamp == expected


def test_fields(spark):
    row = micros(spark, "4/22 05:27:15.478   EV , a\t,b ,, c d ")
    assert row.cols == ["EV", "a", "b", "", "c d"] and row.event == "EV" and row.n_fields == 5
    row = micros(spark, "4/22 05:27:15.478  EV, a ,b")
    assert row.cols == ["EV", "a", "b"] and row.n_fields == 3
    row = micros(spark, "4/22 05:27:15.478  ,a")
    assert row.event is None and row.header_error.startswith("Empty CSV")
    row = micros(spark, '4/22 05:27:15.478  EV,"a,b",c', quote_aware=True)
    assert row.cols == ["EV", '"a,b"', "c"] and row.n_fields == 3
    assert micros(spark, "4/22 05:27:15.478-5 X").tz_offset == "-5"
    assert micros(spark, "4/22 05:27:15.478 X").tz_offset is None
