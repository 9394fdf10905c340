"""Edge cases of the column functions and traps of their semantics."""

import datetime

import pytest
from pyspark.sql import functions as F

from custodia.functions import items, keys, text


def values(spark, fn, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_parse_key(spark):
    names = ["SITE_073", "site#7", "SITE_120A", "SITE_12A", "SITE_0733", "SITE_122_Part_1_of_2_Staging", "SITE_073_2024_04_08.zip", "SITE_073_Uploaded.zip", "x", None, " SITE_4 ", "SITE_120A_metadata.json"]
    assert values(spark, lambda c: keys.parse_key(c), names) == ["073", "007", "120A", None, None, "122_Part_1_of_2", "073", "073", None, None, "004", "120A"]


def test_normalize_key(spark):
    given = ["4", "004", "120A", "122 Part 1 of 2", "1234", "12A", "", None]
    assert values(spark, keys.normalize_key, given) == ["004", "004", "120A", "122_Part_1_of_2", None, None, None, None]
    assert values(spark, keys.key_error, ["4", "12A", "1234"]) == [None, "a suffix needs three digits", "not a key"]


def test_parse_key_cell(spark):
    given = ["", "73.0", "73.00", "SITE 073 (2024)", "SITE#120A", "0733_backup", "12A", "n/a", "1000", "12 / 13", "site 122 Part 1 of 2", "[5]", "SITE 12A x", None]
    got = values(spark, lambda c: keys.parse_key_cell(c), given)
    assert [g["key"] for g in got] == [None, "073", "073", "073", "120A", None, None, None, None, None, "122_Part_1_of_2", "005", None, None]
    assert got[8]["reason"] == "out of range" and got[9]["reason"] == "ambiguous: 2 numbers" and got[7]["reason"] == "no digits" and got[0]["reason"] == "blank"


def test_key_text_and_patterns(spark):
    assert values(spark, keys.key_in_text, ["about SITE#073 and SITE#9", "SITE 12A", "nothing"]) == ["073", "012", None]
    assert values(spark, lambda c: keys.like_capture(c, ["Data (*) SITE#*", "Old *"]), ["data (x) site#123 y", "Old 007", "Data SITE#123"]) == ["123", "007", None]
    assert values(spark, lambda c: keys.parse_part(c)["i"], ["122_Part_2_of_2", "122"]) == [2, None]
    assert [r["n"] for r in values(spark, keys.key_sort, ["073", "120A"])] == [73, 120]


def test_days_and_times(spark):
    assert values(spark, items.day_key, ["19700101_000000.WAV", "20241332_1.wav", "2024_x"]) == ["1970_01_01", "2024_13_32", None]
    assert values(spark, items.item_timestamp, ["20240408_101112.WAV", "20240408_101160.WAV", "20241332_000000.wav", "00000101_000000.wav", "x"]) == [datetime.datetime(2024, 4, 8, 10, 11, 12), None, None, None, None]
    assert values(spark, items.item_year, ["20240408_x.wav", "2024011_x.wav", "20241332.wav", "00000101_x.wav"]) == [2024, None, None, None]


@pytest.mark.parametrize(("rule", "want"), [("audit", [1, 1, 0, 1, 0]), ("prep", [1, 1, 0, 0, 0]), ("split", [1, 1, 0, 0, 0]), ("gate", [1, 1, 1, 1, 0])])
def test_item_rules_differ(spark, rule, want):
    assert values(spark, lambda c: items.is_item(c, rule), ["a.WAV", "a.Wav", "._a.wav", ".a.wav", "a.txt"]) == [bool(w) for w in want]


def test_sizes_round_half_to_even(spark):
    assert values(spark, items.size_kb_text, [128, 0, 1024, 384], "long") == ["0.12", "0.00", "1.00", "0.38"]
    assert values(spark, items.human_size, [1023, 1024, 1024**2, 1024**3, 5 * 1024**4], "long") == ["1023 B", "1.00 KB", "1.00 MB", "1.00 GB", "5120.00 GB"]


def test_headers(spark):
    head = lambda n: b"RIFF" + (n - 8).to_bytes(4, "little") + b"WAVE"
    rows = [(0, b""), (0, b"x"), (100, head(100)), (90, head(100)), (110, head(100)), (5000, b"junk"), (2**32, b""), (3_000_000_000, head(3_000_000_000))]
    got = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, n long, h binary").orderBy("i").select(items.classify_size("n", "h")).collect()
    assert [r[0]["discrepancy"] for r in got] == [None, "empty by its size, but readable", None, "truncated", "trailing data", "no header", None, None]
    assert [r[0]["is_zero"] for r in got] == [True] + [False] * 7 and [r[0]["is_tiny"] for r in got] == [False, False, True, True, True, False, False, False]


def test_titles_fold_case_and_space(spark):
    got = values(spark, text.norm_title, [" STRASSE  x ", "straße X", "near"])
    assert got[0] == got[1] != got[2]


def test_versions(spark):
    got = values(spark, text.bump_version, ["1", "1a", "1A", "1Ax", "1z", "abc", "", "1B", "1ab", "1Az"])
    assert [g["next"] for g in got] == ["1a", "1b", "1Aa", "1Ay"] + [None] * 6
    assert all(g["error"] for g in got[4:])


def test_first_difference(spark):
    rows = [("a" * 300, "a" * 250 + "b" * 50), ("abc", "abc"), ("abc", "abcd"), ("", "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(text.first_diff("a", "b")).collect()] == [250, None, 3, 0]


def test_first_difference_of_long_texts(spark):
    one = "ab ß" * 100_000
    rows = [(one, one[:350_001] + "#" + one[350_002:]), (one, one + "x"), (one, one), (one, "#" + one[1:]), (one, one[:-1] + "#"), (one[:64], one[:63] + "#"), (one, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(text.first_diff("a", "b")).collect()] == [350_001, 400_000, None, 0, 399_999, 63, None]


def test_small_text_functions(spark):
    assert values(spark, lambda c: text.shorten(c, 10), ["a  b", "x" * 20]) == ["a b", "x" * 9 + "…"]
    assert values(spark, text.escape_phrase, ['a"b\\c']) == ['"a\\"b\\\\c"']
    assert values(spark, lambda c: text.render_template("{v} {w}", {"v": c}), ["x"]) == ["x {w}"]
    assert values(spark, lambda c: text.sample_text(F.split(c, ","), 2), ["b,a", "c,b,a"]) == ["a, b", "a, b, ... (3)"]
    assert text.pick_column(["Name: ", "x"], "name") == "Name: "
