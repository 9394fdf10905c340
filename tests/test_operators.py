"""Operators against brute force, and the readers and streams on files of their own."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from custodia.operators import coverage, dedup, integrity, layout, logs, metadata, ranking, records, split, state, verdicts
from custodia.sources import files, sinks
from custodia.streaming import state as streams

import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_split_is_the_best_cut(spark):
    r = random.Random(42)
    rows, want = [], {}
    for s in range(120):
        sizes = [r.choice([0, 1, 5, r.randint(0, 100)]) for _ in range(r.randint(1, 12))]
        rows += [(f"s{s}", f"20240101_{i:06d}.wav", b) for i, b in enumerate(sizes)]
        gaps = {k: abs(2 * sum(sizes[:k]) - sum(sizes)) for k in range(1, len(sizes))}
        want[f"s{s}"] = max((k for k in gaps if gaps[k] == min(gaps.values())), default=None)
    plan = split.split_plan(spark.createDataFrame(rows, "site string, name string, bytes long"))
    got = {r.site: r.n or None for r in plan.groupBy("site").agg(F.count_if(F.col("part") == 1).alias("n")).collect()}
    assert got == want
    assert split.verify_plan(plan).count() == 0


def test_cuts_on_plateaus_that_ranges_divide(spark):
    """Sites whose middle is a long row of empty items, the first or last item, or nothing but empty items."""
    plans = {"flat": [5] + [0] * 900 + [5], "empty": [0] * 700, "first": [99] + [1] * 30, "last": [1] * 30 + [99], "upper": [4, 3] + [0] * 800 + [3, 3], "two": [0, 7], "one": [3]}
    rows = [(s, f"20240101_00{i // 60:02d}{i % 60:02d}.wav", b) for s, sizes in plans.items() for i, b in enumerate(sizes)]
    plan = split.split_plan(spark.createDataFrame(rows, "site string, name string, bytes long"))
    got = {r.site: r.n or None for r in plan.groupBy("site").agg(F.count_if(F.col("part") == 1).alias("n")).collect()}
    for s, sizes in plans.items():
        gaps = {k: abs(2 * sum(sizes[:k]) - sum(sizes)) for k in range(1, len(sizes))}
        assert got[s] == max((k for k in gaps if gaps[k] == min(gaps.values())), default=None), s
    assert split.verify_plan(plan).count() == 0


def test_unparsable_names_come_last(spark):
    df = spark.createDataFrame([("s", "zz.wav", 1), ("s", "20240102_000000.wav", 1), ("s", "20240101_000000.WAV", 1), ("s", "Ab.wav", 1)], "site string, name string, bytes long")
    assert [r.name for r in split.positions(df).orderBy("i").collect()] == ["20240101_000000.WAV", "20240102_000000.wav", "Ab.wav", "zz.wav"]


def test_swapped_sizes_do_not_match(spark):
    one = spark.createDataFrame([("s", "a", 1), ("s", "b", 2)], "site string, name string, bytes long")
    two = spark.createDataFrame([("s", "a", 2), ("s", "b", 1)], "site string, name string, bytes long")
    assert {r.status for r in integrity.reconcile(one, two).collect()} == {"size_differs"}


def test_self_check_fires(spark):
    f = spark.createDataFrame([("s", "disk", "a", 1, False, True, None)], "site string, side string, name string, bytes long, is_zero boolean, is_tiny boolean, discrepancy string")
    stats = integrity.side_stats(f)
    assert integrity.self_check(f, stats).count() == 0
    assert integrity.self_check(f, stats.withColumn("n_items", F.lit(5))).first()["problem"] == "count"


def test_missing_keys_equal_set_difference(spark):
    r = random.Random(42)
    a, b = ([str(r.randrange(100)) for _ in range(80)] for _ in range(2))
    got = coverage.missing_keys(spark.createDataFrame([(x,) for x in a], "key string"), spark.createDataFrame([(x,) for x in b], "key string")).collect()
    assert {x.key for x in got if x.side == "master"} == set(a) - set(b) and {x.key for x in got if x.side == "report"} == set(b) - set(a)


def test_merge_policies(spark):
    c = spark.createDataFrame([("1", "c", False)], "id string, title string, draft boolean")
    a = spark.createDataFrame([("1", "a", True)], "id string, title string, draft boolean")
    x, y = (records.merge_sources(c, a, p).first() for p in ("community", "account"))
    assert (x.title, x.draft, x.error) == ("c", False, None) and (y.title, y.draft, y.error) == ("a", None, "listings disagree")


def test_null_facts_do_not_hold(spark):
    f = spark.sql("SELECT CAST(NULL AS STRING) AS log_id, false AS has_log, false AS has_metadata, false AS prior_success, true AS has_archive, false AS in_done_set, CAST(NULL AS BOOLEAN) AS metadata_row, '' AS latest_failure")
    assert verdicts.missing_state_cause(f).first()["verdict"] == "no evidence"
    assert verdicts.missing_state_cause(f.withColumn("metadata_row", F.lit(False))).first()["verdict"] == "no metadata row"
    assert verdicts.any_attention(f.withColumn("verdict", F.lit("x")), "audit")


def test_versions_of_one_record_are_no_duplicates(spark):
    r = spark.createDataFrame([("1", "p", "k", "T"), ("2", "p", "k", "t "), ("3", "q", None, ""), ("4", "r", None, "")], "id string, parent string, key string, title string")
    assert dedup.duplicate_groups(r).count() == 0


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for site in ("SITE_001", "SITE_002"):
        (root / site).mkdir()
        (root / site / "20240101_000000.wav").write_bytes(b"RIFF" + (92).to_bytes(4, "little") + b"WAVE" + bytes(88))
        (root / site / "._x.wav").write_bytes(b"")
        with zipfile.ZipFile(root / site / "a.zip", "w") as z:
            z.writestr("d/one.wav", b"1")
            z.writestr("e/one.wav", b"22")
    (root / "SITE_002" / "bad.zip").write_bytes(b"not an archive")
    (root / "SITE_001" / "upload_state.json").write_text(json.dumps({"record_id": "7"}))
    (root / "SITE_002" / "upload_state.json").write_text("{broken")
    return root


def test_readers(spark, tree):
    inv = files.read_inventory(spark, str(tree)).collect()
    assert sum(r.sidecar for r in inv) == 2 and {r.bytes for r in inv if r.name.endswith("00.wav")} == {100}
    paths = spark.createDataFrame([(s, str(tree / s / n)) for s, n in (("SITE_001", "a.zip"), ("SITE_002", "a.zip"), ("SITE_002", "bad.zip"))], "site string, path string")
    index = files.read_archive_index(paths).collect()
    assert [(r.name, r.bytes, r.error) for r in index if r.site == "SITE_001"] == [("one.wav", 2, "repeated name")]
    assert [r.error.split(":")[0] for r in index if r.site == "SITE_002"] == ["unreadable"]
    item = spark.createDataFrame([("s", str(tree / "SITE_001" / "20240101_000000.wav")), ("s", str(tree / "none"))], "site string, path string")
    assert [len(r.header) if r.header else None for r in files.read_headers(item).collect()] == [12, None]
    assert sorted(len(r.sha512 or "") for r in files.hash_files(item).collect()) == [0, 128]
    docs = {r.site: r for r in files.read_state_docs(spark, f"{tree}/*/upload_state.json").collect()}
    assert docs["SITE_001"].tries == "0 (legacy)" and docs["SITE_002"].note == "unreadable"


def test_dirty_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿Site#;Name;Name\n1;x;y\n".encode())
    (tmp_path / "b.csv").write_bytes('Site,Name\n1,"caf\xe9 ""q"""\n'.encode("cp1252"))
    assert [tuple(r) for r in files.read_dirty_csv(spark, str(tmp_path / "a.csv")).collect()] == [("1", "y")]
    assert files.read_dirty_csv(spark, str(tmp_path / "b.csv")).first()["Name"] == 'café "q"'
    assert files.choose_key_column(["x", "Site"]) == "Site"
    with pytest.raises(ValueError):
        files.choose_key_column(["my site", "site two"])
    assert files.read_report(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0
    df = spark.createDataFrame([(1, True), (2, False)], "a int, success boolean")
    sinks.write_report(df, str(tmp_path / "r"), ["success", "a"])
    assert files.read_report(spark, str(tmp_path / "r"), ["a"]).columns == ["success", "a"]
    sinks.append_results(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).where("outcome = 'failure'").count() == 1


def test_cache_goes_by_seconds(spark):
    inv = spark.sql("SELECT 's' AS site, 'a' AS name, 5L AS bytes, timestamp_millis(1700000000900) AS mtime")
    old = spark.sql("SELECT 's' AS site, 'a' AS name, 5L AS bytes, 1700000000L AS mtime_s, 'x' AS sha512, 'y' AS md5")
    assert state.cache_status(inv, old).first()["status"] == "reused"
    assert state.cache_status(inv, old, recheck=True).first()["status"] == "hashed"


def test_streams(spark, tmp_path):
    src, done, cache = (str(tmp_path / x) for x in ("src", "done", "cache"))
    schema = "site string, name string, bytes long, mtime timestamp"
    spark.sql("SELECT 's' AS site, 'a' AS name, 5L AS bytes, timestamp '2024-01-01' AS mtime").write.mode("append").parquet(src)
    hashed = lambda due: due.select("site", "name", F.sha2("name", 512).alias("sha512"), F.md5("name").alias("md5"))
    run = lambda: streams.refresh_stream(spark.readStream.schema(schema).parquet(src), hashed, cache, str(tmp_path / "c1")).awaitTermination()
    run()
    spark.sql("SELECT 's' AS site, 'b' AS name, 6L AS bytes, timestamp '2024-01-02' AS mtime").write.mode("append").parquet(src)
    run()
    assert sorted(r.name for r in spark.read.parquet(cache).collect()) == ["a", "b"]
    paths = spark.readStream.schema(schema).parquet(src).select(F.col("name").alias("path"))
    streams.append_done(paths, done, str(tmp_path / "c2")).awaitTermination()
    streams.append_done(paths, done, str(tmp_path / "c3")).awaitTermination()
    assert sorted(r.path for r in spark.read.parquet(done).collect()) == ["a", "b"]
    events = spark.readStream.schema(schema).parquet(src).select("site", F.col("mtime").alias("at"), F.col("name").alias("record_id"))
    q = streams.attempts(events).writeStream.outputMode("complete").format("memory").queryName("tries").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.tries for r in spark.table("tries").collect()) == [1, 1]  # one row for each day


def test_duplicate_groups_keep_every_document(spark, tmp_path):
    texts = ["Straße", "Straße", "İzmir", "İzmir", "plain", "plain", None, "once"]
    spark.createDataFrame([(i, t, f"s{i // 6}") for i, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["a05_duplicate_groups"](spark, str(tmp_path)).collect()
    assert sorted(r.id for r in got if r.type == "title") == [0, 1, 2, 3, 4, 5]
    assert sorted(r.id for r in got if r.type == "key") == [0, 1, 2, 3, 4, 5]  # s1 has one title only
    numbered = entry.queries()["w03_group_numbers"](spark, str(tmp_path)).collect()
    assert len(numbered) == 12 and {r.group_no for r in numbered} == {1, 2, 3, 4}


def test_numbers_and_sums_go_on_from_range_to_range(spark):
    r = random.Random(3)
    rows = [("hot" if r.random() < 0.6 else f"s{r.randrange(5)}", r.randrange(10**6), r.randrange(9)) for _ in range(3000)]
    got = ranking.running(spark.createDataFrame(rows, "site string, v long, b long"), ["site"], [F.col("v"), F.col("b")], "i", {"before": "b"}).collect()
    for site in {x[0] for x in rows}:
        total, want = 0, []
        for n, (_, v, b) in enumerate(sorted(x for x in rows if x[0] == site), 1):
            want.append((n, v, b, total))
            total += b
        assert sorted((x.i, x.v, x.b, x.before) for x in got if x.site == site) == want
    assert ranking.running(spark.createDataFrame([], "v long"), [], [F.col("v")], "i").count() == 0


def test_first_names(spark):
    rows = [("a", f"n{i % 13:02d}") for i in range(40)] + [("b", "x"), ("b", None), ("c", None)]
    got = {r.k: (r.names, r.n_names) for r in ranking.first_names(spark.createDataFrame(rows, "k string, name string"), ["k"], 3).collect()}
    assert got == {"a": (["n00", "n01", "n02"], 13), "b": (["x"], 1)}
    numbers = spark.createDataFrame([(None, i % 30) for i in range(90)] + [(7, 5)], "k long, name long").repartition(5)
    assert {r.k: (r.names, r.n_names) for r in ranking.first_names(numbers, ["k"], 2).collect()} == {None: ([0, 1], 30), 7: ([5], 1)}


def test_log_lines_are_found_by_what_they_hold(spark):
    lines = spark.createDataFrame(list(enumerate(["failed SITE 073 late", "SITE_073_x failed", "site 073 failed", "SITE 7", "nothing", "", "SITE 73 and SITE 073 Timeout"])), "line_no long, line string")
    keys = spark.createDataFrame([("073", "SITE 073"), ("073", "SITE_073"), ("073", "SITE 73"), ("007", "SITE 7"), ("999", "")], "key string, spelling string")
    counts, last = logs.scan_logs(lines, keys, ["failed", "late"], 1)
    assert {r.key: r.n_lines for r in counts.collect()} == {"073": 3, "007": 2}
    assert [(r.key, r.line_no) for r in last.collect()] == [("073", 1)]
    assert logs.scan_logs(lines, keys.limit(0), ["x"])[0].count() == 0


def test_results_logs(spark, tmp_path):
    (tmp_path / "r.csv").write_text("site,error_message\n73,first\nSITE 073,last\n4,\nn/a,x\n")
    assert {r.key: r.error_message for r in files.read_results(spark, str(tmp_path / "r.csv")).collect()} == {"073": "last", "004": ""}
    assert files.read_results(spark, str(tmp_path / "none.csv")).count() == 0


def test_changes_are_rendered(spark):
    pair = lambda **d: spark.createDataFrame([(1, d)], "id long, doc map<string,string>")
    got = {r.key: (r.change, r.detail) for r in integrity.key_diff(pair(a="x", b="1  2", c="y" * 300), pair(b="3", c="y" * 250 + "z", d="new")).collect()}
    assert got == {"a": ("removed", "x"), "b": ("CHANGED", "1 2  ->  3"), "c": ("CHANGED", "300 -> 251 chars, first difference at offset 250"), "d": ("added", "new")}


def test_canary_counts_actionable_rows_only(spark):
    rows = spark.createDataFrame([(i, i % 2 == 0) for i in range(8)], "id long, actionable boolean")
    got = {r.id: r.label for r in records.canary(rows, [F.desc("id")], 2).collect()}
    assert [got[i] for i in (6, 4, 2, 0, 1)] == ["planned", "planned", "skipped", "skipped", "not actionable"]


def test_sites_name_what_blocks_them(spark):
    rows = [("s", f"{i:02d}.wav", 0 if i < 12 else 5, i) for i in range(14)] + [("t", "a.wav", 1, 10**9)]
    d = spark.createDataFrame(rows, "site string, name string, bytes long, t long").withColumn("mtime", F.timestamp_seconds("t"))
    got = {r.site: r for r in layout.blocking(d, 2).collect()}
    assert (got["s"].names_zero, got["s"].n_old, got["t"].names_zero, got["t"].n_old) == ("00.wav, 01.wav, ... (12)", 14, "", 0)
    assert layout.group_by_day(d.select("site", "name")).first()["refused"].startswith("undatable: ")


def test_every_cause_has_an_action(spark):
    assert set(verdicts.ACTIONS) == {"state lost, id in the log", "log unreadable", "creation failed", "prepared again after success", "no archive", "in the done-set", "no metadata row", "failed before creation", "no evidence"}


def test_blank_references_are_skipped(spark):
    rows = spark.createDataFrame([(" a ",), ("",), (None,)], "reference string")
    assert [r.reference for r in metadata.references(rows).collect()] == ["a"]
