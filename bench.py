"""Headline timings over log files rendered from ``lineitem``; prints one JSON line.

The files are written before the clock starts. Each query reads the text, so its time
holds the scan, and ends in the no-op sink or a small result.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import linewright as L
from linewright.plans import render as R

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def write_logs(spark: SparkSession, folder: Path) -> int:
    """One damage, heal or aura line per line item, in a file per task."""
    items = R.table(spark, SF_DIR, "lineitem")
    key, price = R.LINE_KEY, "cast(cast(round(l_extendedprice * 100) as bigint) as string)"
    qty = "cast(cast(l_quantity as bigint) as string)"
    target = ["concat('Creature-', l_suppkey)", "concat('\"Mob ', l_suppkey, '\"')"]
    hit = [price, qty, "'4'", "'nil'", "'0'", "'7'", "'1'", "'nil'", "'nil'"]
    head = [R.actors(key), R.spell(key)]
    body = f"""case l_linenumber % 3
        when 0 then {R.csv("'SPELL_DAMAGE'", *head, *target, *hit)}
        when 1 then {R.csv("'SPELL_HEAL'", *head, price, qty, "'nil'", "'1'")}
        else {R.csv("'SPELL_AURA_APPLIED'", *head, "'BUFF'")} end"""
    lines = R.lines(items, "''", key, R.TIME.format("l_shipdate"), body).select("raw")
    lines.repartition(2 * int(CPUS)).write.text(str(folder / "parts"))
    for i, part in enumerate(sorted((folder / "parts").glob("part-*.txt"))):
        part.rename(folder / f"2024_{i:03d}.txt")
    return items.count()


def main() -> None:
    spark = session()
    folder = Path(tempfile.mkdtemp(prefix="linewright-bench-"))
    n = write_logs(spark, folder)
    work = tempfile.mkdtemp(prefix="linewright-bench-out-")
    read = lambda: L.read_lines(spark, str(folder))
    done = lambda df: df.write.format("noop").mode("overwrite").save()

    def header_route() -> DataFrame:
        routed = L.route_events(L.parse_header(read()), L.RouteRegistry())
        return routed.select("event_time", "event", "route", "n_fields")

    runs = {
        "scan_lines": lambda: done(read()),
        "header_route": lambda: done(header_route()),
        "event_profile": lambda: done(L.event_profile(L.parse_header(read()))),
        "damage_payload": lambda: done(L.payload(L.parse_events(read()), "damage", "file", "line_no")),
        "actors_and_spell": lambda: done(L.parse_events(read()).select("actors", "spell")),
        "full_parse": lambda: done(L.parse_events(read())),
        "file_status": lambda: done(L.file_status(L.parse_events(read()))),
        "convert": lambda: L.convert(spark, str(folder), f"{work}/staged", f"{work}/out"),
    }
    seconds: dict[str, float] = {}
    for name, run in runs.items():
        times = []
        for _ in range(2):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "log_parse_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "lines": n,
                "lines_per_sec": {k: int(n / v) for k, v in seconds.items()},
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
