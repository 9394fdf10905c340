"""The log scan against a plain reading of the lines."""

import random
import time

import pytest
from pyspark.sql import functions as F

from custodia.operators import logs
from custodia.sources import files


def brute(lines, spelt, words, n):
    counts, last = {}, {}
    for at, line in lines:
        for k in {k for k, s in spelt if s and line is not None and s in line}:
            counts[k] = counts.get(k, 0) + 1
            if any(w in line for w in words):
                last.setdefault(k, []).append((at, line.strip()))
    return counts, {k: v[-n:] for k, v in last.items()}


@pytest.mark.parametrize(("pattern_bytes", "held"), [(16 << 20, 32 << 20), (300, 200)])
def test_scan_matches_brute_force(spark, monkeypatch, pattern_bytes, held):
    monkeypatch.setattr(logs, "PATTERN_BYTES", pattern_bytes)
    monkeypatch.setattr(logs, "HELD_BYTES", held)
    r = random.Random(4)
    spelt = [(f"{k:03d}", s) for k in range(30) for s in (f"SITE {k:03d}", f"SITE_{k:03d}", f"SITE {k}")] + [("all", "SITE"), ("é", "é1"), ("x", ""), ("x", None), ("y", "SITE 003")]
    lines = [(i, r.choice([None, "", f"  run SITE {r.randrange(40):03d} failed é{r.randrange(3)} ", f"SITE {r.randrange(40)} and SITE_{r.randrange(40):03d}x late\t", "site 003 failed"])) for i in range(800)]
    df = spark.createDataFrame(lines, "line_no long, line string").repartition(7)
    counts, last = logs.scan_logs(df, spark.createDataFrame(spelt, "key string, spelling string"), ["failed", "late"], 3)
    want = brute(lines, spelt, ["failed", "late"], 3)
    assert {x.key: x.n_lines for x in counts.collect()} == want[0]
    got = {}
    for x in last.sort("line_no").collect():
        got.setdefault(x.key, []).append((x.line_no, x.line))
    assert got == want[1]


def test_lines_keep_the_order_of_files_and_places(spark, tmp_path):
    """Files of several sizes, cut into many ranges: the last lines are those of the last file, in its order."""
    for f, n in (("a.log", 10), ("b.log", 3000), ("c.log", 200)):
        (tmp_path / f).write_text("".join(f"{f} {i} SITE 001 failed\r\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = files.read_log_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 20
        counts, last = logs.scan_logs(lines, spark.createDataFrame([("001", "SITE 001")], "key string, spelling string"), ["failed"], 4)
        assert [x.n_lines for x in counts.collect()] == [3210]
        assert [x.line for x in last.sort("line_no").collect()] == [f"c.log {i} SITE 001 failed" for i in range(196, 200)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_odd_bytes_and_long_lines(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"\xff\xfe SITE 007 failed\n" + b"SITE " * 400_000 + b"007 failed\n")
    began = time.perf_counter()
    counts, last = logs.scan_logs(files.read_log_lines(spark, str(tmp_path)), spark.createDataFrame([("007", "SITE 007"), ("s", "S")], "key string, spelling string"), ["failed"])
    assert {x.key: x.n_lines for x in counts.collect()} == {"007": 2, "s": 2}
    assert {len(x.line) for x in last.where("key = '007'").collect()} == {18, 2_000_010}
    assert time.perf_counter() - began < 30


def test_spellings(spark):
    got = spark.createDataFrame([("073",), ("073A_x",), ("000",)], "key string").select(logs.spellings("key").alias("s")).collect()
    assert [r.s for r in got] == [["SITE 073", "SITE_073", "SITE 73"], ["SITE 073A_x", "SITE_073A_x", "SITE 073A x"], ["SITE 000", "SITE_000", "SITE 0"]]
