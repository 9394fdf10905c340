"""Readers of files against plain Python: inventories, dealing by bytes, archives, tables read in ranges."""

import csv
import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from custodia.sources import dealing, files, inventory, tables


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def sites(tmp_path_factory):
    root = tmp_path_factory.mktemp("sites")
    for s in range(12):
        (root / f"SITE_{s:03d}").mkdir()
        for i in range(s * 3):
            (root / f"SITE_{s:03d}" / (f"._f{i}" if i % 5 == 0 else f"f{i}")).write_bytes(b"x" * i)
        (root / f"SITE_{s:03d}" / "folder").mkdir()
    (root / "a file").write_text("x")
    os.symlink(root / "nowhere", root / "SITE_001" / "dangling")
    return root


@pytest.mark.parametrize(("slices", "ranges"), [(1, 1), (5, 1), (3, 4)])
def test_inventory_lists_every_file_once(spark, sites, slices, ranges):
    got = sorted((r.site, r.name, r.bytes, r.sidecar, r.error) for r in files.read_inventory(spark, str(sites), slices, ranges).collect())
    want = sorted((s, n, os.path.getsize(sites / s / n), n.startswith("._"), None) for s in os.listdir(sites) if (sites / s).is_dir() for n in os.listdir(sites / s) if (sites / s / n).is_file())
    assert got == want
    at = files.read_inventory(spark, str(sites)).where("name = 'f1'").select(F.unix_seconds("mtime").alias("t")).first().t
    assert at == int(os.stat(sites / "SITE_001" / "f1").st_mtime)


def test_site_filters_reach_the_source(spark, sites):
    inv = files.read_inventory(spark, str(sites), 4)
    one = inv.where("site = 'SITE_003'")
    assert "PushedFilters: [IsNotNull(site), EqualTo(site,SITE_003)]" in plan(one).replace("*", "") or "EqualTo(site,SITE_003)" in one._jdf.queryExecution().explainString(one._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert one.rdd.getNumPartitions() == 1 and one.count() == 9
    assert inv.where("site IN ('SITE_003', 'SITE_004', '..', 'SITE_003/folder', 'none') AND bytes > 3").count() == 5 + 8
    assert inv.where("site LIKE 'SITE_01%'").count() == 30 + 33
    assert inv.where("site LIKE 'SITE_01%' AND site = 'SITE_002'").count() == inv.where("site IS NULL").count() == 0
    assert inv.where("site <> 'SITE_011'").count() == inv.count() - 33


def test_pushed_filters_by_themselves():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

    reader = inventory.SiteReader("/none", 4, 2)
    rest = [GreaterThan(("bytes",), 3), GreaterThan(("site",), "a")]
    assert list(reader.pushFilters([In(("site",), ("ab", "ac", "b", "a/b")), rest[0], StringStartsWith(("site",), "a"), rest[1]])) == rest
    assert [(p.sites, p.part) for p in reader.partitions()] == [(["ab"], 0), (["ab"], 1), (["ac"], 0), (["ac"], 1)]
    assert list(reader.pushFilters([EqualTo(("site",), "ac")])) == [] and len(reader.partitions()) == 2
    assert list(reader.pushFilters([StringStartsWith(("site",), "b")])) == [] and reader.partitions() == []


def test_largest_task_has_the_mean_and_one_file_at_most(spark):
    r = random.Random(8)
    sizes = [r.choice([0, 1, 10, 10**6, r.randrange(10**9), 40 * 10**9]) for _ in range(700)]
    df = spark.createDataFrame([("s", f"p{i}", b) for i, b in enumerate(sizes)] + [("s", "none", None)], "site string, path string, bytes long")
    dealt = dealing.deal_by_bytes(df, 40, open_cost=100)
    assert dealt.columns == df.columns
    loads = [0] * 40
    rows = dealt.select(F.spark_partition_id().alias("t"), "path", F.coalesce("bytes", F.lit(0)).alias("b")).collect()
    for x in rows:
        loads[x.t] += x.b + 100
    assert sorted(x.path for x in rows) == sorted([f"p{i}" for i in range(700)] + ["none"])
    assert max(loads) <= sum(loads) / 40 + max(sizes) + 100
    first = {x.t: x.b for x in reversed(rows)}
    assert first[0] == max(sizes)  # the largest start first
    assert dealing.deal_by_bytes(df.limit(0), 3).count() == 0
    assert dealing.deal_by_bytes(df.withColumn("bytes", F.lit(0)), 7, 0).count() == 701


def test_archives_of_a_site_are_one_index(spark, tmp_path):
    def archive(name, *entries):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for e, data in entries:
                z.writestr(e, data)
        return str(tmp_path / name)

    one = archive("a.zip", ("x/one.wav", b"1"), ("x/", b""), ("two.wav", b"22"))
    two = archive("b.zip", ("y/one.wav", b"333"), ("z/CONFIG.TXT", b""))
    (tmp_path / "bad.zip").write_bytes(b"PK")
    rows = [("s", one, 9), ("s", two, 10**9), ("t", two, None), ("t", str(tmp_path / "bad.zip"), 2), ("u", str(tmp_path / "none.zip"), 0)]
    df = spark.createDataFrame(rows, "site string, path string, bytes long")
    for paths in (df, df.drop("bytes")):
        got = sorted((r.site, r.archive, r.name or "", r.bytes, r.error) for r in files.read_archive_index(paths).collect())
        assert got == [
            ("s", "a.zip", "two.wav", 2, None), ("s", "b.zip", "CONFIG.TXT", 0, None), ("s", "b.zip", "one.wav", 3, "repeated name"),
            ("t", "bad.zip", "", None, "unreadable: BadZipFile"), ("u", "none.zip", "", None, "unreadable: FileNotFoundError"),
        ]
    assert sorted((r.archive, r.n) for r in files.read_archive_entries(df).where("site = 's'").collect()) == [("a.zip", 0), ("a.zip", 2), ("b.zip", 0), ("b.zip", 1)]
    items = spark.createDataFrame([("s", one, 5), ("s", str(tmp_path / "none"), 7)], "site string, path string, bytes long")
    assert sorted(len(r.sha512 or "") for r in files.hash_files(items).collect()) == [0, 128]
    assert [len(r.header) for r in files.read_headers(items).where("header IS NOT NULL").collect()] == [12]


def reference(data: bytes):
    """Rows as Python's csv reads them, as dictionaries."""
    try:
        text = data.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = data.decode("latin-1").translate(tables._CP1252)
    line = next((x for x in text.replace("\r", "\n").split("\n") if x), "")
    rows = (r for r in csv.reader(io.StringIO(text, newline=""), delimiter=";" if ";" in line and "," not in line else ",") if r)
    header = [h.strip() for h in next(rows, [])]
    return [{h: r[i] if i < len(r) else None for i, h in enumerate(header)} for r in rows]


def odd_table(r, encoding, sep, end):
    cell = lambda: r.choice(["", "a", "é ü", '"q"', '"a ""b"" c"', f'"x{sep}y"', '"line\nbreak\r\nin it"', '"\n\n"', 'mid"dle', '"closed"more', '""', '" "', '"","', "  ", '"open"" still\n"'])
    rows = [sep.join(r.choice(["Site", "Näme", "x y", "Site"]) + str(i % 3) for i in range(4))]
    rows += [sep.join(cell() for _ in range(r.randint(1, 5))) for _ in range(r.randint(0, 60))]
    rows.insert(r.randint(0, len(rows)), "")
    text = end.join(rows) + r.choice(["", end, end + end, '"never closed' + end + "a"])
    return text.encode(encoding, "ignore")


@pytest.mark.parametrize("size", [1, 8, 13, 64])
def test_states_of_ranges_compose(size):
    """Ranges of any size own each record once, wherever they cut."""
    r = random.Random(size)
    for _ in range(150):
        data = odd_table(r, r.choice(["utf-8", "utf-8-sig", "cp1252"]), r.choice([b",", b";"]).decode(), r.choice(["\n", "\r\n", "\r"]))
        begin = 3 if data.startswith(tables._MARK) else 0
        line = data[begin:].lstrip(b"\r\n").replace(b"\r", b"\n").split(b"\n")[0]
        sep = b";" if b";" in line and b"," not in line else b","
        starts = list(range(begin, max(len(data), begin + 1), size))
        state, owned, facts = tables.FIELD_START, [], []
        for a in starts:
            b = min(a + size, len(data))
            after = tables._end_state(data[a:b], 0, state, sep)
            owned.append(tables._owned(io.BytesIO(data), a, b, len(data), begin, state, after, sep))
            facts.append(tables._utf8_facts(data[a:b], data[b : b + 3], a == begin))
            state = after
        assert b"".join(owned) == data[begin:]
        text = data.decode("latin-1")
        whole = list(csv.reader(io.StringIO(text[begin:], newline=""), delimiter=sep.decode()))
        parts = [row for o in owned for row in csv.reader(io.StringIO(o.decode("latin-1"), newline=""), delimiter=sep.decode())]
        assert [x for x in parts if x] == [x for x in whole if x]
        if size < 8:
            continue
        try:
            data.decode("utf-8")
            valid = True
        except UnicodeDecodeError:
            valid = False
        assert valid == (all(f[0] for f in facts) and all(x[2] == y[1] for x, y in zip(facts, facts[1:])) and facts[-1][2] == 0)


def test_tables_of_many_dialects(spark, tmp_path):
    r = random.Random(2)
    made = [odd_table(r, e, s, n) for e in ("utf-8", "utf-8-sig", "cp1252") for s in (",", ";") for n in ("\n", "\r\n")]
    for i, data in enumerate(made):
        (tmp_path / f"t{i:02d}.csv").write_bytes(data)
    key = lambda d: tuple((str(k), str(v)) for k, v in sorted(d.items()))
    for i, data in enumerate(made):
        want = reference(data)
        got = files.read_dirty_csv(spark, str(tmp_path / f"t{i:02d}.csv"), 50)
        assert sorted(key(x.asDict()) for x in got.collect()) == sorted(map(key, want))
    both = files.read_dirty_csv(spark, str(tmp_path), 80)
    assert both.count() == sum(len(reference(d)) for d in made)
    notes = {os.path.basename(x.path): x for x in tables.table_notes(spark, str(tmp_path), 50).collect()}
    assert [notes[f"t{i:02d}.csv"].sep for i in range(12)] == [",", ",", ";", ";"] * 3


def test_a_table_of_one_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [[f"{i:03d}", f"first\nsecond {i}", "x" * (i % 50)] for i in range(4000)]
    with open(tmp_path / "big.csv", "w", newline="") as f:
        csv.writer(f).writerows([["Site#", "Note", "Rest"], *rows])
    df = files.read_dirty_csv(spark, str(tmp_path / "big.csv"), 4096)
    spread = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(spread) > 10 and max(x["count"] for x in spread) < 1500
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, rows))
    (tmp_path / "empty.csv").write_bytes(b"")
    assert files.read_dirty_csv(spark, str(tmp_path / "empty.csv")).count() == 0
    (tmp_path / "head.csv").write_bytes(b"a,b")
    assert files.read_dirty_csv(spark, str(tmp_path / "head.csv")).columns == ["a", "b"]
